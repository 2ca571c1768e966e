"""Exact top-k inner products by a score-at-a-time index ordered by impact.

Components are quantised to integers. The index is a table of blocks of vectors. A posting's impact is the
distance of its value from the middle one of its dimension, quantised to its power of two; a block keeps
its postings in segments by descending quantised impact, and within one by dimension. For a group of
queries segments are processed in that order. What is unseen of a dimension adds or takes at most its
largest impact in the segments left, so after every segment a vector has bounds of its score, and queries
are dropped one by one as their bounds decide. Bounds travel: each query first meets a few probe blocks,
and the k-th best score there is what it takes to all blocks. A query leaves a block only with a proof that
no other vectors than those it scores exactly can be among its k best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import by_group, written

INDEX = "block long, n int, dims int, ids binary, asked binary, data binary, counts binary, positions binary, impacts binary"
DEPTH = 20  # segments of a block; the last one has all that is left


def usable(vectors: DataFrame, asked: Column) -> DataFrame:
    """vec_id, embedding, asked of the rows that take part: no null id, vector or component, all components finite."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long"), x.cast("array<double>").alias("embedding"), F.coalesce(asked, F.lit(False)).alias("asked"))
    return rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine)


def segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings of a block (n x dims) by descending quantised impact: counts (segments x dims), positions, and signed impacts."""
    off = data - np.partition(data, len(data) // 2, axis=0)[len(data) // 2]
    power = np.frexp(np.abs(off).astype(float))[1]
    level = np.minimum(power.max(initial=0) - power, DEPTH - 1)
    counts, positions, impacts = [], [], []
    for n in range(DEPTH):
        dim, at = np.nonzero(((level == n) & (off != 0)).T)
        counts.append(np.bincount(dim, minlength=data.shape[1])), positions.append(at), impacts.append(off[at, dim])
    return np.array(counts, np.int32), np.concatenate(positions).astype(np.uint16), np.concatenate(impacts).astype(np.int64)


def index(vectors: DataFrame, scale: float, per_block: int) -> DataFrame:
    """A row per block of at most ``per_block`` vectors (vec_id, embedding, asked) of a task: ids, data (n x dims int64) and
    ``segments``. Shorter vectors are filled up with zeros."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, rest = TaskContext.get().partitionId() << 32, None

        def block(g: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            dims = max(1, max(map(len, g["embedding"])))
            data = np.zeros((len(g), dims), np.int64)
            for i, v in enumerate(g["embedding"]):
                data[i, : len(v)] = np.floor(np.asarray(v, float) * scale)
            counts, positions, impacts = segments(data)
            number += 1
            return pd.DataFrame({
                "block": [number], "n": [len(g)], "dims": [dims], "ids": [g["vec_id"].to_numpy(np.int64).tobytes()],
                "asked": [g["asked"].to_numpy(bool).tobytes()], "data": [data.tobytes()],
                "counts": [counts.tobytes()], "positions": [positions.tobytes()], "impacts": [impacts.tobytes()],
            })

        for b in batches:
            rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
            while len(rest) >= per_block:
                yield block(rest.iloc[:per_block])
                rest = rest.iloc[per_block:]
        if rest is not None and len(rest):
            yield block(rest)

    return vectors.mapInPandas(run, INDEX)


class Block:
    """The vectors of a block and its segments, each as the vectors that it has postings of and their impacts (dims x vectors)."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, counts: np.ndarray, positions: np.ndarray, impacts: np.ndarray):
        self.ids, self.data = ids, data
        dims, self.read = data.shape[1], 0  # postings so far
        self.centre = np.partition(data, len(data) // 2, axis=0)[len(data) // 2].astype(float)
        self.segments, lo = [], 0
        for n in counts:
            hi = lo + int(n.sum())
            at, place = np.unique(positions[lo:hi], return_inverse=True)
            impact = np.zeros((dims, len(at)))
            impact[np.repeat(np.arange(dims), n), place] = impacts[lo:hi]
            self.segments.append((at, impact, hi - lo))
            lo = hi
        #: The most that postings from a segment on can be above and below the middle, by dimension; 0 after the last.
        most = lambda f: np.maximum.accumulate(np.array([np.zeros(dims), *(f(m).max(axis=1, initial=0) for _, m, _ in self.segments[::-1])]))[::-1]
        self.above, self.below = most(lambda m: m), most(lambda m: -m)

    def possible_members(self, q: np.ndarray, k: int, least: np.ndarray) -> list[np.ndarray]:
        """For each query (row of q) positions of all vectors that can be among the k best of the block and score ``least`` or more."""
        n, out, left = len(self.data), [np.empty(0, int)] * len(q), np.arange(len(q))
        up, down = np.maximum(q, 0), np.maximum(-q, 0)
        slack = 1e-9 * (np.abs(q) @ (np.abs(self.centre) + self.above[0] + self.below[0]) + 1)  # more than sums of doubles can be off
        seen = np.repeat((q @ self.centre)[:, None], n, axis=1)
        for at in [n for n, (_, _, size) in enumerate(self.segments) if size] + [len(self.segments)]:
            more, less = up[left] @ self.above[at] + down[left] @ self.below[at], up[left] @ self.below[at] + down[left] @ self.above[at]
            floor = np.maximum(least[left], np.partition(seen, n - k, axis=1)[:, n - k] - less) if k <= n else least[left]
            alive = seen + more[:, None] >= (floor - slack[left])[:, None]
            found = alive.sum(axis=1)
            done = (found <= 4 * k) | (at == len(self.segments))
            for i in np.flatnonzero(done):
                out[left[i]] = np.flatnonzero(alive[i])
            left, seen = left[~done], seen[~done]
            if not len(left):
                break
            vectors, impact, size = self.segments[at]
            if len(vectors) == n:
                seen += q[left] @ impact
            else:
                seen[:, vectors] += q[left] @ impact
            self.read += size * len(left)
        return out

    def best(self, q: np.ndarray, k: int, least: np.ndarray, own: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each query (score, id) of the k best that score ``least`` or more, ties to the smaller id; position ``own`` (or -1) is left out."""
        dims = self.data.shape[1]
        q = np.pad(q[:, :dims], ((0, 0), (0, max(0, dims - q.shape[1]))))
        out = []
        for x, m, at, low in zip(q, self.possible_members(q.astype(float), k + 1, least), own, least, strict=True):
            m = m[m != at]
            score = self.data[m] @ x
            keep = np.lexsort((self.ids[m], -score))[:k]
            out.append([(int(score[i]), int(self.ids[m[i]])) for i in keep if score[i] >= low])
        return out


def matches(blocks: DataFrame, queries: DataFrame, k: int, together: int) -> DataFrame:
    """q_block, q_at, query_id, score, vec_id: of every bucket's blocks the k best for each of its queries that score ``least`` or more.

    blocks: rows of the index and ``bucket``. queries: bucket, q_block, q_at, query_id, q, least. A bucket's
    blocks come first and ``together`` queries at a time pass them; the k-th best so far is the next block's bound.
    """
    kinds = blocks.drop("asked").withColumn("kind", F.lit(0)).unionByName(queries.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Block] = {}

        def answer(asked: list) -> pd.DataFrame:
            widest = max(len(r.q) for r in asked) // 8
            q = np.zeros((len(asked), widest), np.int64)
            for i, r in enumerate(asked):
                q[i, : len(r.q) // 8] = np.frombuffer(r.q, np.int64)
            least = np.array([-np.inf if r.open else float(r.least) for r in asked])
            found: list[list[tuple[int, int]]] = [[] for _ in asked]
            for name, block in held.items():
                own = np.array([int(r.q_at) if r.q_block == name else -1 for r in asked])
                for i, more in enumerate(block.best(q, k, least, own)):
                    found[i] = sorted(found[i] + more, key=lambda x: (-x[0], x[1]))[:k]
                    if len(found[i]) == k:
                        least[i] = max(least[i], found[i][-1][0])
            rows = [(r.q_block, r.q_at, r.query_id, score, vec_id) for r, got in zip(asked, found, strict=True) for score, vec_id in got]
            return pd.DataFrame(rows, columns=["q_block", "q_at", "query_id", "score", "vec_id"]).astype({"score": "int64", "vec_id": "int64"})

        for g in by_group(batches, ["bucket", "kind"]):
            if g["kind"].iloc[0] == 0:
                held = {}
                for r in g.itertuples(index=False):
                    n, dims = int(r.n), int(r.dims)
                    held[r.name] = Block(
                        np.frombuffer(r.ids, np.int64), np.frombuffer(r.data, np.int64).reshape(n, dims), np.frombuffer(r.counts, np.int32).reshape(DEPTH, dims),
                        np.frombuffer(r.positions, np.uint16), np.frombuffer(r.impacts, np.int64),
                    )
                bucket = g["bucket"].iloc[0]
            elif held and g["bucket"].iloc[0] == bucket:
                rows = list(g.itertuples(index=False))
                for lo in range(0, len(rows), together):
                    yield answer(rows[lo : lo + together])

    # pandas makes doubles of longs with nulls: such columns travel as strings
    text = [F.coalesce(F.col(c).cast("string"), F.lit("0")).alias(c) for c in ("q_block", "q_at", "query_id", "least", "n", "dims")]
    name = F.coalesce(F.col("block").cast("string"), F.lit("")).alias("name")
    dealt = kinds.select("bucket", "kind", name, "ids", "data", "counts", "positions", "impacts", "q", F.col("least").isNull().alias("open"), *text)
    found = dealt.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInPandas(run, "q_block string, q_at string, query_id string, score long, vec_id long")
    return found.select(F.col("q_block").cast("long"), F.col("q_at").cast("int"), F.col("query_id").cast("long"), "score", "vec_id")


def asked_rows(blocks: DataFrame) -> DataFrame:
    """q_block, q_at, query_id, q: the vectors of the index that are queries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                at = np.flatnonzero(np.frombuffer(r.asked, bool))
                data, ids = np.frombuffer(r.data, np.int64).reshape(r.n, r.dims), np.frombuffer(r.ids, np.int64)
                if len(at):
                    yield pd.DataFrame({"q_block": np.full(len(at), r.block), "q_at": at.astype(np.int32), "query_id": ids[at], "q": [data[i].tobytes() for i in at]})

    return blocks.select("block", "n", "dims", "ids", "asked", "data").mapInPandas(run, "q_block long, q_at int, query_id long, q binary")


def top_k(vectors: DataFrame, asked: Column, k: int = 5, scale: float = 256.0, per_block: int = 4096, probes: int = 2, together: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of every query row with all other rows.

    vectors: vec_id, embedding; other columns do not matter. ``asked`` (a condition) tells which rows are
    queries. Components count as floor(scale * x); scores must fit a long. Every row is a candidate but the
    query's own, so rows that share a vec_id count one by one, as queries too; ties go to the smaller
    vec_id. Rows with a null id, vector or component or one that is not finite take no part. Fewer than k
    others give fewer rows; without vectors or queries the result is empty. The ``probes`` fullest blocks
    give every query the bound that it takes to the others; ``together`` queries go to them at a time.
    """
    blocks = written(index(usable(vectors, asked), scale, per_block))
    queries = written(asked_rows(blocks))
    n_blocks, chunks = max(1, blocks.count()), max(1, -(-queries.count() // together))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    probe = blocks.join(F.broadcast(blocks.orderBy(F.desc("n"), "block").select("block").limit(probes)), "block", "left_semi")  # ``probes`` numbers
    chunk = F.pmod(F.xxhash64("q_block", "q_at"), F.lit(chunks)).cast("int")
    first = matches(probe.withColumn("bucket", every(chunks)), queries.withColumns({"bucket": chunk, "least": F.lit(None).cast("long")}), k, together)
    bound = first.groupBy("q_block", "q_at").agg(F.when(F.count("*") == k, F.min("score")).alias("least"))

    bounded = queries.join(bound, ["q_block", "q_at"], "left").withColumn("bucket", every(n_blocks))
    found = matches(blocks.withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(n_blocks)).cast("int")), bounded, k, together)
    best = Window.partitionBy("q_block", "q_at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
