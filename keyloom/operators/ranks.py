"""Row numbers within groups that may be as large as the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.session import checkpointed


def numbered(df: DataFrame, by: list[str], order: list[str], name: str = "n") -> DataFrame:
    """df with ``name``: the row's number, from 1, among the rows with equal ``by``, in ascending ``order``.

    Rows are range-partitioned and sorted; a group's numbers go on from one partition to the next, so that no
    group meets in one task. ``order`` should tell rows apart: equal ones stay in one partition.
    """
    placed = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_at", F.monotonically_increasing_id())
    placed = checkpointed(placed).withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    so_far = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = parts.withColumn("_before", F.coalesce(F.sum("_size").over(so_far), F.lit(0))).drop("_size")
    met = placed.join(parts, [*by, "_part"])
    return met.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias(name))
