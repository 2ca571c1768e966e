"""Hard negatives for contrastive training, by disjoint score slots.

An anchor's positives set the upper limits of its windows. The limits, in descending order, cut the scores
into disjoint slots, and for a window that begins at a limit only the rows of that slot and those below
it count. Every task keeps the k best rows of a slot (as do the combiners before the shuffle), and one
sweep from the lowest slot up merges them, so that all windows of an anchor, however they overlap, are
answered by the merged list at their limit, cut at their lower end.

Vectors stand in blocks. A block's anchors travel together as one matrix to the buckets of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import by_group, written

BLOCK = "block long, n int, dims int, ids binary, labels binary, data binary, dtype string, anchors binary"
AT_ONCE = 128  # anchors whose scores with a block are held together


def usable(vectors: DataFrame, anchor: Column) -> DataFrame:
    """vec_id, label, embedding, anchor of rows without null ids, labels or vectors whose components are all finite."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), x.cast("array<double>").alias("embedding"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)


def quantised(vectors: list[np.ndarray], scale: float) -> np.ndarray:
    """floor(scale * x) in the smallest integers that hold it, shorter vectors filled up with zeros."""
    out = np.zeros((len(vectors), max(1, max(map(len, vectors)))))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(np.asarray(v, float) * scale)
    if np.abs(out).max() >= 2.0**62:
        raise ValueError("components times the scale must be below 2^62")
    whole = out.astype(np.int64)
    return whole.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= whole.min() and whole.max() <= np.iinfo(t).max))


def blocks_of(vectors: DataFrame, scale: float, per_block: int) -> DataFrame:
    """A row per block of at most ``per_block`` rows of a task, by ascending vec_id; ``anchors`` has positions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, rest = TaskContext.get().partitionId() << 32, None

        def block(g: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            number += 1
            g = g.sort_values("vec_id", kind="stable")
            data = quantised(list(g["embedding"]), scale)
            return pd.DataFrame({
                "block": [number], "n": [len(g)], "dims": [data.shape[1]], "ids": [g["vec_id"].to_numpy(np.int64).tobytes()], "labels": [g["label"].to_numpy(np.int64).tobytes()],
                "data": [data.tobytes()], "dtype": [data.dtype.str], "anchors": [np.flatnonzero(g["anchor"].to_numpy(bool)).tobytes()],
            })

        for b in batches:
            rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
            while len(rest) >= per_block:
                yield block(rest.iloc[:per_block])
                rest = rest.iloc[per_block:]
        if rest is not None and len(rest):
            yield block(rest)

    return vectors.mapInPandas(run, BLOCK)


class Rows:
    """Some rows of a block."""

    def __init__(self, r, at: np.ndarray | None = None):
        self.block, self.dims = int(r.block), int(r.dims)
        data = np.frombuffer(r.data, np.dtype(r.dtype)).reshape(int(r.n), self.dims)
        ids, labels = np.frombuffer(r.ids, np.int64), np.frombuffer(r.labels, np.int64)
        self.data, self.ids, self.labels = (data, ids, labels) if at is None else (data[at], ids[at], labels[at])
        self.largest = int(np.abs(self.data.astype(np.int64)).max(initial=0))

    def scores(self, others: Rows) -> np.ndarray:
        """Integer inner products; in doubles where those are exact, which lets them use the matrix product."""
        dims = min(self.dims, others.dims)
        most = self.largest * others.largest * dims
        if most >= 2**63:
            raise ValueError("scores must fit a long")
        kind = np.float64 if most < 2**53 else np.int64
        return (self.data[:, :dims].astype(kind) @ others.data[:, :dims].astype(kind).T).astype(np.int64)


def anchors_of(blocks: DataFrame) -> DataFrame:
    """The blocks' anchors: rows like blocks, of their anchors alone, with their positions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                at = np.frombuffer(r.anchors, np.int64)
                if len(at):
                    x = Rows(r, at)
                    yield pd.DataFrame({
                        "block": [r.block], "n": [len(at)], "dims": [r.dims], "ids": [x.ids.tobytes()], "labels": [x.labels.tobytes()],
                        "data": [x.data.tobytes()], "dtype": [r.dtype], "anchors": [r.anchors],
                    })

    return blocks.mapInPandas(run, BLOCK)


def best(score: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Positions, out of ``at`` (ascending, so that ties go to the smaller id), of the k highest scores, in order."""
    if len(at) > k:
        s = score[at]
        at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return at[np.argsort(-score[at], kind="stable")[:k]]


def upper_limits(scores: list[int], low: int, high: int) -> list[int]:
    """Distinct upper limits, descending, of the windows that can hold a score: low * s <= 100 * x <= high * s."""
    return sorted({high * s // 100 for s in scores if -(-low * s // 100) <= high * s // 100}, reverse=True)


def met(blocks: DataFrame, asked: DataFrame, buckets: int, pick, schema: str, k: int) -> DataFrame:
    """What ``pick`` takes for every anchor out of every block, at most k of an anchor and slot from a bucket.

    pick(scores, own position or -1, own label, labels, the anchor's scores in ``extra``) -> positions, slot by slot.
    asked: rows of ``anchors_of`` and ``extra``.
    """
    everywhere = asked.withColumns({"bucket": F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))), "kind": F.lit(1)})
    held = blocks.withColumns({"bucket": F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("int"), "kind": F.lit(0)})

    def answer(r, known: list[Rows]) -> pd.DataFrame:
        anchors, at = Rows(r), np.frombuffer(r.anchors, np.int64)
        told = {} if r.extra is None else {x["a_at"]: x["scores"] for x in r.extra}
        extra = [told.get(i, ()) for i in at.tolist()]
        found: list[list[np.ndarray]] = []
        for lo in range(0, len(at), AT_ONCE):
            part = Rows(r, np.arange(lo, min(lo + AT_ONCE, len(at))))
            for rows in known:
                scores = part.scores(rows)
                for i, score in enumerate(scores, lo):
                    own = int(at[i]) if rows.block == anchors.block else -1
                    for slot, p in enumerate(pick(score, own, anchors.labels[i], rows.labels, extra[i])):
                        if len(p):
                            found.append([np.full(len(p), i), np.full(len(p), slot), score[p], rows.ids[p]])
        i, slot, score, ids = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 4
        order = np.lexsort((ids, -score, slot, i))
        i, slot, score, ids = i[order], slot[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (slot[1:] != slot[:-1])]) if len(i) else np.empty(0, int)
        keep = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)])) < k
        return pd.DataFrame({"a_block": anchors.block, "a_at": at[i[keep]].astype(np.int64), "anchor_id": anchors.ids[i[keep]], "slot": slot[keep].astype(np.int32), "score": score[keep], "vec_id": ids[keep]}).astype({"a_block": "int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, known = None, []
        for g in by_group(batches, ["bucket", "kind"]):
            if g["kind"].iloc[0] == 0:
                bucket, known = g["bucket"].iloc[0], [Rows(r) for r in g.itertuples(index=False)]
            elif g["bucket"].iloc[0] == bucket:
                for r in g.itertuples(index=False):
                    yield answer(r, known)

    rows = held.unionByName(everywhere, allowMissingColumns=True)
    return rows.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInPandas(run, schema)


FOUND = "a_block long, a_at long, anchor_id long, slot int, score long, vec_id long"


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of every anchor and slot, with their ``place``."""
    best_first = Window.partitionBy("a_block", "a_at", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, k: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, per_block: int = 8192, together: int = 8) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors: vec_id, label, embedding; other columns do not matter. ``anchor`` (a condition) tells which rows are
    anchors. Components count as floor(scale * x), scores are integer inner products and must fit a long; higher
    ones come first, ties by smaller vec_id. An anchor's positives are its first ``positives`` other rows of its
    label. For each of them come the first k rows of other labels with low * positive_score <= 100 *
    negative_score <= high * positive_score; fewer give fewer rows, and a negative positive_score gives none. Rows
    with a null id, label, vector or component, or one that is not finite, take no part. Rows that share a
    vec_id count one by one, as anchors, positives and negatives. Without rows or anchors the result is empty.
    """
    blocks = written(blocks_of(usable(vectors, anchor), scale, per_block))
    asked = written(anchors_of(blocks))
    n = blocks.count()
    buckets = max(1, -(-n // together), min(n, vectors.sparkSession.sparkContext.defaultParallelism))

    def same(score, own, label, labels, extra) -> list[np.ndarray]:
        at = np.flatnonzero(labels == label)
        return [best(score, at[at != own], positives)]

    none = F.lit(None).cast("array<struct<a_at:bigint,scores:array<bigint>>>").alias("extra")
    near = written(ranked(met(blocks, asked.select("*", none), buckets, same, FOUND, positives), positives))

    # At most ``positives`` scores of every anchor of a block.
    scores = near.groupBy("a_block", "a_at").agg(F.collect_list("score").alias("scores"))
    limits = scores.groupBy("a_block").agg(F.collect_list(F.struct("a_at", "scores")).alias("extra"))

    def slots(score, own, label, labels, extra) -> list[np.ndarray]:
        uppers = upper_limits(list(map(int, extra)), low, high)
        if not uppers:
            return []
        lowest = min(-(-low * int(s) // 100) for s in extra if s >= 0)
        at = np.flatnonzero((score <= uppers[0]) & (score >= lowest) & (labels != label))
        of = np.searchsorted(-np.array(uppers), -score[at], side="right") - 1  # the last limit that is not below the score
        return [best(score, at[of == i], k) for i in range(len(uppers))]

    told = asked.join(limits, asked["block"] == limits["a_block"]).drop("a_block")
    apart = ranked(met(blocks, told, buckets, slots, FOUND, k), k)

    sides = near.withColumn("kind", F.lit(0)).unionByName(apart.withColumn("kind", F.lit(1)))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in by_group(batches, ["a_block", "a_at"]):
            rows: list[tuple] = []
            pos = [(int(r.score), int(r.vec_id)) for r in g.itertuples(index=False) if r.kind == 0]
            below = [(int(r.slot), -int(r.score), int(r.vec_id)) for r in g.itertuples(index=False) if r.kind == 1]
            uppers, merged, suffix = upper_limits([s for s, _ in pos], low, high), [], {}
            for slot in range(len(uppers) - 1, -1, -1):  # from the lowest up: what stands below a limit, k best
                merged = sorted(merged + [(s, v) for at, s, v in below if at == slot])[:k]
                suffix[uppers[slot]] = merged
            for s, v in pos:
                fits = [(-x, y) for x, y in suffix.get(high * s // 100, []) if -100 * x >= low * s]
                rows += [(int(g["anchor_id"].iloc[0]), v, i, y, s, x) for i, (x, y) in enumerate(fits, 1)]
            if rows:
                yield pd.DataFrame(rows, columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    order = ["a_block", "a_at", "kind", "place"]
    return sides.repartition("a_block", "a_at").sortWithinPartitions(*order).mapInPandas(answer, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
