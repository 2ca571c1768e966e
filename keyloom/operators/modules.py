"""Keys of module types: what can be done with them, exact top-k rebuilds, restore verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.operators.ranks import numbered

# Module types and how they are carried. The sketch type goes by two names.
DISPOSITION = {
    "rejson-rl": "json_rebuild",
    "topk-type": "topk_rebuild",
    "mbbloom--": "restore_only",
    "mbbloomcf": "restore_only",
    "cmsk-type": "restore_only",
    "cms-type": "restore_only",
    "tsdb-type": "not_supported",
    "tdis-type": "not_supported",
    "graphdata": "not_supported",
    "vectorset": "not_supported",
}


def disposition(kind: Column) -> Column:
    """How keys of a module type are carried; unknown types can only be restored."""
    out = F.lit("restore_only")
    for name, what in DISPOSITION.items():
        out = F.when(F.lower(kind) == name, what).otherwise(out)
    return out


def dispositions(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """keys (type, ..) with how they are carried and why not, by rules (type, disposition, reason) that ignore case.

    Types without a rule can only be restored.
    """
    r = rules.select(F.lower("type").alias("_type"), "disposition", "reason")
    met = keys.join(r, F.lower(keys["type"]) == r["_type"], "left").drop("_type")
    return met.withColumns({"disposition": F.coalesce("disposition", F.lit("restore_only")), "reason": F.coalesce("reason", F.concat(F.lit("no rule for the type "), "type"))})


def topk_plan(items: DataFrame, max_incr: int = 100_000, pairs: int = 900) -> DataFrame:
    """(key, call, item, incr): increments that rebuild exact counts (key, item, count), so many pairs a call."""
    n = F.ceil(F.col("count") / max_incr).cast("int")
    steps = items.filter("count > 0").withColumn("step", F.explode(F.sequence(F.lit(1), n)))
    incr = F.least(F.lit(max_incr), F.col("count") - (F.col("step") - 1) * max_incr)
    n = numbered(steps.withColumn("incr", incr.cast("long")).select("key", "item", "step", "incr"), ["key"], ["item", "step"])
    return n.select("key", F.floor((F.col("n") - 1) / pairs).cast("long").alias("call"), "item", "incr")


def topk(items: DataFrame, k: int, by: str = "item") -> DataFrame:
    """The k most frequent items, ties by item."""
    return items.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by).limit(k)


def restore_verdicts(source: DataFrame, readback: DataFrame) -> DataFrame:
    """(type, encoding, accepted, reason): one sample key per pair, its source digest against what the target gave back (key, digest, error)."""
    s = source.withColumn("encoding", F.coalesce("encoding", F.lit("unknown")))
    one = s.groupBy("type", "encoding").agg(F.min(F.struct("key", "digest")).alias("one")).select("type", "encoding", "one.key", F.col("one.digest").alias("want"))
    met = one.join(readback.select("key", F.col("digest").alias("got"), "error"), "key", "left")
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("got").isNull(), "not there after the restore").when(F.col("got") != F.col("want"), "value differs after the restore")
    return met.select("type", "encoding", reason.isNull().alias("accepted"), reason.alias("reason"))


def route_by_verdict(entries: DataFrame, verdicts: DataFrame) -> DataFrame:
    """entries with route fast (opaque copy) or typed; pairs without a verdict are typed."""
    e = entries.withColumn("_e", F.coalesce("encoding", F.lit("unknown")))
    v = verdicts.select(F.col("type").alias("_t"), F.col("encoding").alias("_v"), "accepted")
    met = e.join(v, (e["type"] == v["_t"]) & (e["_e"] == v["_v"]), "left")
    return met.withColumn("route", F.when(F.col("accepted"), "fast").otherwise("typed")).drop("_e", "_t", "_v", "accepted")
