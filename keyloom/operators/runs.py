"""Run history: size drops, outages, progress, lag, passes and the cutover verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def size_drops(samples: DataFrame, percent: int = 50) -> DataFrame:
    """samples (run_id, ts, size) whose size fell by so many percent or more since the one before (integer division)."""
    before = F.lag("size").over(Window.partitionBy("run_id").orderBy("ts"))
    s = samples.withColumn("previous", before)
    if percent <= 0:
        return s.limit(0)
    return s.filter((F.col("previous") > 0) & (F.col("size") <= F.floor(F.col("previous") * (100 - percent) / 100)))


def outages(log: DataFrame) -> DataFrame:
    """(run_id, down_at, up_at, seconds) of a connection log (run_id, ts, seq, state up or down); repeats of a state are ignored."""
    w = Window.partitionBy("run_id").orderBy("ts", "seq")
    changes = log.withColumn("_was", F.lag("state").over(w)).filter("_was is null or _was <> state")
    up = changes.withColumn("up_at", F.lead("ts").over(w)).filter("state = 'down'")
    return up.select("run_id", F.col("ts").alias("down_at"), "up_at", (F.unix_timestamp("up_at") - F.unix_timestamp("ts")).alias("seconds"))


def progress(samples: DataFrame, max_quiet: int = 3) -> DataFrame:
    """samples (run_id, ts, source, target) with percent, gained, quiet (samples in a row without change) and state."""
    w = Window.partitionBy("run_id").orderBy("ts")
    s = samples.withColumn("gained", F.col("target") - F.lag("target").over(w))
    moved = F.sum(F.when(F.coalesce(F.col("gained"), F.lit(1)) != 0, 1).otherwise(0)).over(w)
    s = s.withColumn("_m", moved)
    s = s.withColumn("quiet", F.row_number().over(Window.partitionBy("run_id", "_m").orderBy("ts")) - 1).drop("_m")
    state = F.when(F.col("target") >= F.col("source"), "caught_up").when(F.col("quiet") >= max_quiet, "stalled").otherwise("copying")
    percent = F.when(F.col("source") > 0, F.floor(F.col("target") * 100 / F.col("source"))).otherwise(100)
    return s.withColumns({"percent": percent.cast("long"), "state": state})


def lag_report(positions: DataFrame, masters: DataFrame, pending: DataFrame) -> DataFrame:
    """(shard, bytes_behind, seconds_behind, pending, caught_up) from positions (shard, offset, caught_up_at), masters (shard, master_offset, now) and pending (shard, key)."""
    n = pending.groupBy("shard").agg(F.count("*").alias("pending"))
    met = masters.join(positions, "shard", "left").join(n, "shard", "left")
    behind = F.greatest(F.lit(0), F.col("master_offset") - F.coalesce("offset", F.lit(0)))
    left = F.coalesce("pending", F.lit(0))
    done = (behind == 0) & (left == 0)
    return met.select("shard", behind.alias("bytes_behind"), F.when(done, 0).otherwise(F.col("now") - F.col("caught_up_at")).alias("seconds_behind"), left.alias("pending"), done.alias("caught_up"))


def clean_since(passes: DataFrame) -> DataFrame:
    """(run_id, clean_since): start of the last FULL pass if it found no difference, else 0; samples do not count."""
    full = passes.filter("mode = 'FULL'").groupBy("run_id").agg(F.max_by(F.struct("started_at", "differences"), "finished_at").alias("p"))
    return full.select("run_id", F.when(F.col("p.differences") == 0, F.col("p.started_at")).otherwise(0).alias("clean_since"))


def cutover_verdict(facts: DataFrame, max_lag: int = 5) -> DataFrame:
    """(run_id, verdict) from facts (run_id, caught_up, lag, queued, pending, clean_since, since).

    LAGGING before NOT_SAFE before UNREVIEWED before SAFE; a reader that never caught up (null) is behind.
    """
    ahead = F.coalesce(F.col("caught_up") if max_lag == 0 else F.col("caught_up") | (F.col("lag") <= max_lag) & F.col("caught_up").isNotNull(), F.lit(False))
    clean = (F.col("clean_since") > 0) & (F.col("clean_since") >= F.col("since"))
    verdict = (
        F.when(~(ahead & (F.col("queued") == 0)), "LAGGING").when(~F.coalesce(clean, F.lit(False)), "NOT_SAFE")
        .when(F.col("pending") > 0, "UNREVIEWED").otherwise("SAFE")
    )
    return facts.select("run_id", verdict.alias("verdict"))


def reconcile_due(samples: DataFrame, flushed: DataFrame, percent: int = 50) -> DataFrame:
    """(run_id, trigger) of full passes that a size drop or a flush asks for."""
    drops = size_drops(samples, percent).select("run_id", F.format_string("a size drop from %d to %d", "previous", "size").alias("trigger"))
    return drops.unionByName(flushed.select("run_id", F.lit("a flush").alias("trigger"))).distinct()


def run_summary(outcomes: DataFrame) -> DataFrame:
    """(run_id, n per outcome) of outcomes (run_id, outcome)."""
    n = lambda k: F.count_if(F.col("outcome") == k).alias(k)
    return outcomes.groupBy("run_id").agg(F.count("*").alias("scanned"), *(n(k) for k in ("success", "skipped", "failure", "dead_letter")))


def live_totals(counts: DataFrame, outages: DataFrame, drift: DataFrame, letters: DataFrame, times: DataFrame) -> DataFrame:
    """One row a run of ``times`` (run_id, started_at, finished_at, in seconds): what its live phase did and met.

    counts (run_id, name, total): counters such as written, skipped, dropped, as columns of one map. outages as ``outages``
    gives them: disconnects and downtime of those that are over. drift (run_id, severity): critical and advisory ones.
    letters (run_id, key, reviewed): dead letters that nobody has looked at.
    """
    n = lambda test, name: F.count_if(F.coalesce(test, F.lit(False))).alias(name)
    named = counts.groupBy("run_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "total")))).alias("counters"))
    down = outages.groupBy("run_id").agg(F.count("*").alias("disconnects"), F.coalesce(F.sum("seconds"), F.lit(0)).alias("downtime"))
    moved = drift.groupBy("run_id").agg(n(F.col("severity") == "CRITICAL", "critical"), n(F.col("severity") == "ADVISORY", "advisory"))
    left = letters.groupBy("run_id").agg(n(~F.col("reviewed"), "orphans"))
    out = times.select("run_id", (F.col("finished_at") - F.col("started_at")).alias("elapsed"))
    for more in (named, down, moved, left):
        out = out.join(more, "run_id", "left")
    return out.fillna(0, ["disconnects", "downtime", "critical", "advisory", "orphans"])


def rates(samples: DataFrame, max_quiet: int = 3, timeout: int = 600) -> DataFrame:
    """``progress`` with rate (target keys gained a second since the sample before), and state ``timed_out`` when nothing was gained for ``timeout`` seconds."""
    w = Window.partitionBy("run_id").orderBy("ts")
    seconds = F.unix_timestamp("ts")
    s = progress(samples, max_quiet).withColumn("_s", seconds - F.lag(seconds).over(w))
    s = s.withColumn("rate", F.when(F.col("_s") > 0, F.col("gained") / F.col("_s")))
    moved = F.coalesce(F.last(F.when(F.coalesce(F.col("gained"), F.lit(1)) != 0, seconds), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), seconds)
    late = (seconds - moved >= timeout) & (F.col("state") != "caught_up")
    return s.withColumn("state", F.when(late, "timed_out").otherwise(F.col("state"))).drop("_s")


def item_sketches(items: DataFrame, most: int = 10_000) -> DataFrame:
    """run_id, sketch of items (run_id, item): frequent items of each run in at most ``most`` counters, to be kept and merged later."""
    return items.groupBy("run_id").agg(F.expr(f"approx_top_k_accumulate(item, {int(most)})").alias("sketch"))


def frequent_items(sketches: DataFrame, k: int, most: int = 10_000) -> DataFrame:
    """item, n: the k most frequent items over all runs of ``item_sketches``, by estimates.

    An item's estimate is not below its count nor above it by more than N * 3.5 / most for N items in all (the bound of
    the frequent-items sketch); as long as all sketches together hold fewer different items than three quarters of
    ``most``, estimates are exact. Of equal estimates any may come.
    """
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {int(most)})").alias("sketch"))
    return merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {int(k)})")).alias("f")).select("f.item", F.col("f.count").alias("n"))
