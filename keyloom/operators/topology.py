"""Cluster topology: slot ranges, owners, coverage, drift, failover positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def to_ranges(slots: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by.., start, end) of runs of slots (by.., slot)."""
    island = F.col("slot") - F.row_number().over(Window.partitionBy(*by).orderBy("slot"))
    return slots.select(*by, "slot").distinct().withColumn("_i", island).groupBy(*by, "_i").agg(F.min("slot").alias("start"), F.max("slot").alias("end")).drop("_i")


def from_ranges(ranges: DataFrame) -> DataFrame:
    return ranges.withColumn("slot", F.explode(F.sequence("start", "end"))).drop("start", "end")


def key_owner(keys: DataFrame, ranges: DataFrame) -> DataFrame:
    """keys (slot, ..) with the node whose range (node_id, start, end) covers them; ranges become one row per slot, at most 16384."""
    return keys.join(from_ranges(ranges), "slot", "left")


def slot_gaps(ranges: DataFrame, slots: int = 16384) -> DataFrame:
    """Ranges of slots that no node covers."""
    spark = ranges.sparkSession
    return to_ranges(spark.range(slots).withColumnRenamed("id", "slot").join(from_ranges(ranges).select("slot"), "slot", "left_anti"))


def slot_health(nodes: DataFrame, slots: int = 16384) -> DataFrame:
    """One row (status, reason) for nodes (node_id, role, failed, migrating, start, end)."""
    masters = nodes.filter("role = 'master'")
    gaps = slot_gaps(masters.filter("not failed and start is not null").select("node_id", "start", "end"), slots)
    missing = gaps.agg(F.coalesce(F.sum(F.col("end") - F.col("start") + 1), F.lit(0)).alias("missing"))
    facts = nodes.agg(
        F.count_if(F.col("role") == "master").alias("masters"), F.count_if(F.col("failed")).alias("failed"), F.count_if(F.col("migrating")).alias("moving"),
    ).join(missing, how="cross")  # one row each
    reason = (
        F.when(F.col("masters") == 0, "no masters").when(F.col("failed") > 0, F.format_string("%d failed nodes", "failed"))
        .when(F.col("moving") > 0, F.format_string("%d nodes with slots in migration", "moving"))
        .when(F.col("missing") > 0, F.format_string("%d slots uncovered", "missing"))
    )
    return facts.select(F.when(reason.isNull(), "ok").otherwise("failed").alias("status"), reason.alias("reason"))


def topology_diff(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(node_id, change): joined, departed or reassigned for two sets of (node_id, slot); addresses do not matter."""
    held = lambda df, c: df.groupBy("node_id").agg(F.array_sort(F.collect_set("slot")).alias(c))
    met = held(baseline, "b").join(held(current, "c"), "node_id", "full_outer")
    change = F.when(F.col("b").isNull(), "joined").when(F.col("c").isNull(), "departed").when(F.col("b") != F.col("c"), "reassigned")
    return met.select("node_id", change.alias("change")).filter("change is not null")


def drift(snapshots: DataFrame) -> DataFrame:
    """(run_id, snapshot_id, joined, departed, reassigned, severity) of each snapshot (run_id, snapshot_id, node_id, slots) against the run's one before.

    CRITICAL if a node joined, ADVISORY if one left or slots moved, else NONE.
    """
    n = snapshots.select("run_id", "snapshot_id").distinct()
    n = n.withColumn("at", F.row_number().over(Window.partitionBy("run_id").orderBy("snapshot_id")))  # one row per snapshot of a run
    s = snapshots.join(n, ["run_id", "snapshot_id"]).select("run_id", "at", "node_id", F.array_sort("slots").alias("slots"))
    now = s.select("run_id", "at", "node_id", F.col("slots").alias("c"))
    before = s.select("run_id", (F.col("at") + 1).alias("at"), "node_id", F.col("slots").alias("b"))
    met = before.join(now, ["run_id", "at", "node_id"], "full_outer")
    count = lambda test: F.count_if(F.coalesce(test, F.lit(False)))
    found = met.groupBy("run_id", "at").agg(
        count(F.col("b").isNull()).alias("joined"), count(F.col("c").isNull()).alias("departed"), count(F.col("b") != F.col("c")).alias("reassigned"),
    )
    severity = F.when(F.col("joined") > 0, "CRITICAL").when(F.col("departed") + F.col("reassigned") > 0, "ADVISORY").otherwise("NONE")
    return found.join(n, ["run_id", "at"]).filter("at > 1").select("run_id", "snapshot_id", "joined", "departed", "reassigned", severity.alias("severity"))


def resume_positions(shards: DataFrame, positions: DataFrame) -> DataFrame:
    """shards (shard, repl_ids) with the position (repl_id, offset, active) that one of their replication ids has; inactive ones first."""
    met = shards.withColumn("repl_id", F.explode_outer("repl_ids")).join(positions, "repl_id", "left").filter("offset is not null")
    first = Window.partitionBy("shard").orderBy("active", F.desc("offset"))
    best = met.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").select("shard", "repl_id", "offset")
    return shards.select("shard").join(best, "shard", "left")


def db_size(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("side").agg(F.sum("keys").alias("keys"))
