"""Search indexes: definitions from fields, and the plan to rebuild them on every node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.keys import KeyNames

KINDS = ("TEXT", "TAG", "NUMERIC", "GEO", "VECTOR")


def index_args(fields: DataFrame) -> DataFrame:
    """(index, args, supported) from fields (index, position, identifier, attribute, kind, options array<string>)."""
    usable = F.upper("kind").isin(*KINDS)
    alias = F.when(F.col("attribute") != F.col("identifier"), F.array(F.lit("AS"), F.col("attribute"))).otherwise(F.array().cast("array<string>"))
    args = F.concat(F.array("identifier"), alias, F.array(F.upper("kind")), F.coalesce("options", F.array().cast("array<string>")))
    listed = F.array_sort(F.collect_list(F.when(usable, F.struct("position", args.alias("a")))))
    return fields.groupBy("index").agg(listed.alias("l")).select(
        "index", F.flatten(F.col("l.a")).alias("args"), (F.size("l") > 0).alias("supported")
    )


def plan_indexes(definitions: DataFrame, existing: DataFrame, nodes: DataFrame, overwrite: bool = False) -> DataFrame:
    """(index, node, action): create, keep, drop_and_create or unsupported, for definitions (index, supported) on every node.

    The nodes of a cluster are one row, which meets every definition.
    """
    one = nodes.agg(F.array_sort(F.collect_set("node")).alias("_nodes"))
    there = existing.select("index", "node", F.lit(True).alias("_there"))
    met = definitions.select("index", "supported").join(F.broadcast(one), how="cross")
    met = met.select("index", "supported", F.explode("_nodes").alias("node")).join(there, ["index", "node"], "left")
    action = F.when(~F.col("supported"), "unsupported").when(F.col("_there").isNull(), "create").otherwise("drop_and_create" if overwrite else "keep")
    return met.select("index", "node", action.alias("action"))


def map_prefixes(definitions: DataFrame, rules: DataFrame, outer: str = "") -> DataFrame:
    """(index, prefixes): prefix lists under the target's names. rules: old, new.

    A prefix is renamed by the longest old prefix it starts with, and the new prefixes of rules below it are added.
    """
    starts = lambda c: F.transform(F.sequence(F.lit(0), F.length(c)), lambda n: F.left(c, n))
    p = definitions.select("index", F.posexplode("prefixes").alias("pos", "prefix"))
    over = p.select("prefix").distinct().withColumn("old", F.explode(starts("prefix"))).join(rules.select("old", "new"), "old")
    renamed = F.concat("new", F.expr("substring(prefix, length(old) + 1)"))
    over = over.groupBy("prefix").agg(F.max_by(renamed, F.length("old")).alias("own"))
    under = rules.select("old", "new").withColumn("prefix", F.explode(starts("old"))).filter("prefix <> old")
    under = under.join(p.select("prefix").distinct(), "prefix", "left_semi").groupBy("prefix").agg(F.array_sort(F.collect_set("new")).alias("below"))
    met = p.join(over, "prefix", "left").join(under, "prefix", "left")
    listed = F.concat(F.array(F.coalesce("own", "prefix")), F.coalesce("below", F.array().cast("array<string>")))
    per = met.withColumn("list", F.transform(listed, lambda x: F.concat(F.lit(outer), x)))
    return per.groupBy("index").agg(F.array_distinct(F.flatten(F.array_sort(F.collect_list(F.struct("pos", "list")))["list"])).alias("prefixes"))


def mapped_prefixes(prefixes: list[str], names: KeyNames) -> list[str]:
    return list(dict.fromkeys(t for p in prefixes for t in names.target_prefixes(p)))
