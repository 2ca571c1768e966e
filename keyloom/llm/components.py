"""Connected components: alternating large-star and small-star rounds of DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import written


PER_TASK = 250_000  # edges


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than the node is hung on the node's smallest neighbour (or the node)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The node and its smaller neighbours are hung on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _contracted(edges: DataFrame, held: int = 2 * PER_TASK) -> DataFrame:
    """The edges of every task as stars: its nodes hang on the smallest one that the task's edges join them with.

    A task that has met more than ``held`` nodes passes its stars on and begins anew, which bounds its memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        def stars() -> pa.RecordBatch:
            hung = [x for x, y in up.items() if x != y]
            return pa.RecordBatch.from_pydict({"u": pa.array(hung, pa.int64()), "v": pa.array([find(x) for x in hung], pa.int64())})

        for b in batches:
            for x, y in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
                x, y = find(x), find(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
            if len(up) > held:
                yield stars()
                up.clear()
        yield stars()

    return edges.mapInArrow(run, "u long, v long")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", native: bool = False) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node that links reach.

    Edges with a null end and loops take no part (a node with nothing but loops has no row); direction
    and repeats do not matter; no edges give no rows. Nodes are longs, or of any type where ``native``.
    Every round is written to the shared folder. It begins with tasks of about ``PER_TASK`` edges that join
    what their own edges connect; where there is more than one task, large-star and small-star follow.
    Where ``native``, a round is the two stars only. Rounds are logarithmic in practice. A hub's edges are
    aggregated before they are shuffled and meet one row of the smallest neighbour each, a join that
    Spark can split.
    """
    e = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = written(e.distinct() if native else _contracted(e))
    state = _state(e)
    while state[0]:
        tasks = -(-state[0] // PER_TASK)
        if not native:
            e = _contracted(e.coalesce(tasks))
        e = written(_small_star(_large_star(e)) if native or tasks > 1 else e)
        if tasks == 1 and not native:  # all edges met
            break
        before, state = state, _state(e)
        if state == before:
            break
    hung = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return hung.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
