"""Reconcile passes that look closer only where it is needed, and when a pass is due.

Each side is digested into buckets of keys: how many, the sum of 64-bit hashes of the records, and the
exclusive-or of a second hash, all of which are independent of order. Buckets that agree hold the same records,
but for a chance of about 2^-128 a bucket that unlike ones agree; the others go to the full outer join, and with
them the keys that expire, as the time that they have left is compared with a tolerance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.operators import reconcile


def digests(records: DataFrame, name: Column, expires: Column, buckets: int) -> DataFrame:
    """bucket, n, total, mix, unreadable of records (key, type, ttl_ms, size, value, and perhaps unreadable)."""
    what = [name, "type", F.coalesce(expires, F.lit(False)), "size", F.col("value").cast("string")]
    bad = F.coalesce(F.col("unreadable"), F.lit(False)) if "unreadable" in records.columns else F.lit(False)
    rows = records.select(F.pmod(F.xxhash64(name), F.lit(buckets)).alias("bucket"), F.xxhash64(*what).alias("_h"), F.xxhash64(F.lit(1), *what).alias("_g"), bad.alias("_bad"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("total"), F.bit_xor("_g").alias("mix"), F.count_if("_bad").alias("unreadable"))


def unlike(one: DataFrame, other: DataFrame) -> DataFrame:
    """bucket: those whose digests differ, or that hold something unreadable."""
    met = one.alias("a").join(other.alias("b"), "bucket", "full_outer")
    same = F.lit(True)
    for c in ("n", "total", "mix"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return met.filter(~same | (F.coalesce("a.unreadable", F.lit(0)) + F.coalesce("b.unreadable", F.lit(0)) > 0)).select("bucket")


def differential_pass(
    source: DataFrame, target: DataFrame, names: K.KeyNames = K.KeyNames(), buckets: int = 4096, ttl_strategy: str = "PRESERVE", ttl_offset_ms: int = 0, **how
) -> tuple[DataFrame, DataFrame]:
    """(key, reason) as ``reconcile.first_differences`` finds them, and one row (buckets, unlike, source_keys, joined).

    ``joined`` are the source's keys that went to the join. Both sides are read twice, values are moved only for that
    part. Keys are distinct on either side; ``how`` are the other parameters of ``reconcile.compare``.
    """
    own, there = names.to_target(F.col("key")), F.col("key")
    left, left_there = K.effective_ttl(F.col("ttl_ms"), ttl_strategy, ttl_offset_ms) > 0, F.col("ttl_ms") > 0
    named = source.filter(own.isNotNull())
    differing = F.broadcast(unlike(digests(named, own, left, buckets), digests(target, there, left_there, buckets)).withColumn("_unlike", F.lit(True)))  # ``buckets`` rows at most

    def part(side: DataFrame, name: Column, expires: Column) -> DataFrame:
        met = side.withColumn("_b", F.pmod(F.xxhash64(name), F.lit(buckets))).join(differing.withColumnRenamed("bucket", "_b"), "_b", "left")
        return met.filter(F.col("_unlike") | F.coalesce(expires, F.lit(False))).select(*side.columns)

    s = part(named, own, left)
    diffs = reconcile.first_differences(s, part(target, there, left_there), names=names, ttl_strategy=ttl_strategy, ttl_offset_ms=ttl_offset_ms, **how)
    count = lambda df, n: df.agg(F.count("*").alias(n))
    stats = count(differing, "unlike").join(count(named, "source_keys"), how="cross").join(count(s, "joined"), how="cross")  # one row each
    return diffs, stats.select(F.lit(buckets).alias("buckets"), "unlike", "source_keys", "joined")


def pass_due(passes: DataFrame, requests: DataFrame, now: DataFrame, interval: int, mode: str = "SAMPLE") -> DataFrame:
    """(run_id, mode, trigger) of the runs of ``now`` (run_id, now) for which a pass is to begin.

    requests (run_id, at, trigger) of a size drop or a flush ask for a FULL pass, the newest of those since the last FULL pass
    (run_id, started_at, finished_at, mode) began, even while a SAMPLE pass runs (finished_at is null). Otherwise a pass
    of ``mode`` is due when none runs and the last one has been over for ``interval``, or there was none.
    """
    last = passes.groupBy("run_id").agg(
        F.max(F.when(F.col("mode") == "FULL", F.col("started_at"))).alias("_full"), F.max("finished_at").alias("_end"),
        F.max(F.when(F.col("finished_at").isNull(), F.col("mode"))).alias("_running"),
    )
    newest = Window.partitionBy("run_id").orderBy(F.desc("at"), "trigger")
    asked = requests.join(last.select("run_id", "_full"), "run_id", "left").filter(F.col("_full").isNull() | (F.col("at") >= F.col("_full")))
    asked = asked.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").select("run_id", F.col("trigger").alias("_trigger"))
    met = now.join(last, "run_id", "left").join(asked, "run_id", "left")
    idle = F.col("_running").isNull() & (F.col("_end").isNull() | (F.col("now") - F.col("_end") >= interval))
    full = F.col("_trigger").isNotNull() & ~F.coalesce(F.col("_running") == "FULL", F.lit(False))
    return met.filter(full | idle & F.col("_trigger").isNull()).select("run_id", F.when(full, "FULL").otherwise(mode).alias("mode"), F.when(full, F.col("_trigger")).otherwise("schedule").alias("trigger"))
