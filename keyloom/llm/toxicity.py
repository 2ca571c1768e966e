"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the n-grams inside words (with marks for their ends) that a text has or has not. Spark
counts in how many training texts of either class each n-gram is; the log-count ratio
r = log((p + a) / |p|) - log((q + a) / |q|) scales the feature, and a logistic regression is fitted on
the scaled features of a bounded sample of labelled texts. Scoring is one pass over the texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import exact, exact_longs, string_list, written


@dataclass(frozen=True)
class Model:
    """n-gram -> number, weights (already times the log-count ratio), bias."""

    grams: dict[str, int]
    weights: np.ndarray
    bias: float
    sizes: tuple[int, int]


def grams_of(word: str, sizes: tuple[int, int]) -> set[str]:
    w = f"\x02{word}\x03"
    return {w[i : i + n] for n in range(sizes[0], sizes[1] + 1) for i in range(len(w) - n + 1)}


LONG = 1000  # characters: longer words are not remembered, nor all their n-grams held at once
AT_ONCE = 200_000  # n-grams of a text that are told apart at once


def slid(word: str, sizes: tuple[int, int]) -> Iterator[str]:
    """All n-grams of a word, one by one."""
    w = f"\x02{word}\x03"
    return (w[i : i + n] for n in range(sizes[0], sizes[1] + 1) for i in range(len(w) - n + 1))


def distinct_grams(words: set[str], sizes: tuple[int, int]) -> Iterator[set[str]]:
    """The n-grams of a text's words, each once, in parts of a bounded size: by classes of a hash if there are many."""
    if sum(map(len, words)) <= AT_ONCE:
        yield {g for w in words for g in grams_of(w, sizes)}
        return
    long = [f"\x02{w}\x03" for w in words if len(w) > LONG]
    letters = [np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.uint32) for w in long]
    short = [w for w in words if len(w) <= LONG]
    classes = -(-(sizes[1] - sizes[0] + 1) * sum(map(len, words)) // AT_ONCE)
    for part in range(classes):
        found: set[str] = set()
        for w in short:
            found.update(g for g in slid(w, sizes) if mixed_letters(np.frombuffer(g.encode("utf-32-le", "surrogatepass"), np.uint32), len(g))[0] % classes == part)
        for w, a in zip(long, letters, strict=True):
            for n in range(sizes[0], sizes[1] + 1):
                for lo in range(0, max(0, len(a) - n + 1), 1 << 20):
                    h = mixed_letters(a[lo : lo + (1 << 20) + n - 1], n)
                    at = np.flatnonzero(h % np.uint64(classes) == part)
                    _, first = np.unique(h[at], return_index=True)
                    found.update(w[lo + i : lo + i + n] for i in at[first].tolist())
        yield found


def mixed_letters(a: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n neighbouring letters."""
    h = np.full(len(a) - n + 1, 14695981039346656037, np.uint64)
    for i in range(n):
        h = (h ^ a[i : len(a) - n + 1 + i]) * np.uint64(1099511628211)
        h ^= h >> np.uint64(29)
    return h


class WordFeatures(dict):
    """Numbers of a word's kept n-grams; forgets when full."""

    def __init__(self, grams: dict[str, int], sizes: tuple[int, int]):
        self.grams, self.sizes = grams, sizes

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 50_000:
            self.clear()
        kept = self.grams
        if len(word) > LONG:
            return tuple({kept[g] for g in slid(word, self.sizes) if g in kept})
        found = self[word] = tuple(kept[g] for g in grams_of(word, self.sizes) if g in kept)
        return found


def text_features(text: str, of_word: WordFeatures) -> list[int]:
    """The kept n-grams that a text has, each once, in order."""
    return sorted({f for w in set(text.lower().split()) for f in of_word[w]})


def gram_counts(sample: DataFrame, sizes: tuple[int, int], held: int = 150_000) -> DataFrame:
    """(gram, pos, neg): texts of either class with the n-gram. sample: text, label."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush() -> pd.DataFrame:
            grams = list(total[0].keys() | total[1].keys())
            out = pd.DataFrame({"gram": grams, "pos": [total[1][g] for g in grams], "neg": [total[0][g] for g in grams]})
            total[0].clear(), total[1].clear()
            return out.astype({"gram": str, "pos": "int64", "neg": "int64"})

        for b in batches:
            for text, label in zip(string_list(b["text"]), b["label"], strict=True):
                for grams in distinct_grams(set(text.lower().split()), sizes):
                    total[int(label)].update(grams)
                    if len(total[0]) + len(total[1]) > held:
                        yield flush()
        yield flush()

    counted = sample.mapInPandas(run, "gram string, pos long, neg long")
    return counted.groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def logistic(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, l2: float, rounds: int = 150, memory: int = 8) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression on rows of present features, each worth its scale, by L-BFGS."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.concatenate(rows).astype(np.int64)
    x = scale[cols]

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        w, z = v[:-1], np.bincount(at, x * v[cols], len(rows)) + v[-1]
        value = np.logaddexp(0, z).sum() - z @ y + l2 / 2 * (w @ w)
        d = 1 / (1 + np.exp(-np.clip(z, -700, 700))) - y
        return value, np.r_[np.bincount(cols, x * d[at], len(scale)) + l2 * w, d.sum()]

    v = np.zeros(len(scale) + 1)
    v[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    f, g = loss(v)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        p, kept = g.copy(), []
        for s, t, r in reversed(past):
            kept.append(r * (s @ p))
            p -= kept[-1] * t
        p *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(g).sum())
        for (s, t, r), a in zip(past, reversed(kept), strict=True):
            p += (a - r * (t @ p)) * s
        step, slope = 1.0, g @ p
        while step > 1e-10:  # backtracking
            nv = v - step * p
            nf, ng = loss(nv)
            if nf <= f - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        if (nv - v) @ (ng - g) > 1e-12:
            past = [*past[1 - memory :], (nv - v, ng - g, 1 / ((nv - v) @ (ng - g)))]
        done = f - nf < 1e-6 * abs(f)
        v, f, g = nv, nf, ng
        if done:
            break
    return v[:-1], float(v[-1])


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """text, label: at most ``most`` rows, written once. Hashes of ids and texts are cut to them before texts are fetched."""
    marked = labels.filter(f"doc_id is not null and {label} is not null")
    marked = marked.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    first = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # more cannot be used, as every one chosen has an id of its own or shares it
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), F.coalesce("text", F.lit("")).alias("text"))
    there = keyed.select("doc_id", "hash").join(F.broadcast(first), "doc_id").distinct()  # most rows are broadcast
    chosen = there.orderBy(F.xxhash64("doc_id"), "doc_id", "hash").limit(most)
    return written(keyed.join(F.broadcast(chosen), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"]).select("text", "label"))  # most rows are broadcast


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = 20_000, features: int = 4096,
    sizes: tuple[int, int] = (3, 5), least: int = 5, smoothing: float = 1.0, l2: float = 10.0,
) -> Model:
    """Fit on the texts of docs (doc_id, text) that labels (doc_id, ``label`` 0 or 1) marks.

    At most ``most`` labelled texts are used, the first by hashes of doc_id and text, so which ones does not
    depend on the order of rows; a text that is repeated under one id is one. Rows with a null label or id
    are left out; of repeated ids the largest label counts, for every text of that id; null texts are
    empty. Without labelled texts, or without documents, the model gives every text a half.
    """
    sample = labelled_texts(docs, labels, label, most)
    classes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = classes.get(1, 0), classes.get(0, 0)
    ratio = F.log((F.col("pos") + smoothing) / (n_pos + smoothing)) - F.log((F.col("neg") + smoothing) / (n_neg + smoothing))
    counted = gram_counts(sample, sizes).filter(F.col("pos") + F.col("neg") >= least).withColumn("ratio", ratio)
    strength = F.abs("ratio") * F.sqrt(F.col("pos") + F.col("neg"))
    kept = counted.orderBy(strength.desc(), "gram").limit(features).select("gram", "ratio").toPandas()
    grams, scale = {g: i for i, g in enumerate(kept["gram"])}, kept["ratio"].to_numpy(float)

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_word = WordFeatures(grams, sizes)
        for b in batches:
            yield pd.DataFrame({"features": [np.array(text_features(t, of_word), np.int32) for t in string_list(b["text"])], "label": b["label"]})

    rows = sample.mapInPandas(featured, "features array<int>, label int").toPandas()  # <= most rows
    if not len(rows):
        return Model({}, np.zeros(0), 0.0, sizes)
    w, bias = logistic([np.asarray(r, np.int64) for r in rows["features"]], rows["label"].to_numpy(float), scale, l2)
    return Model(grams, w * scale, bias, sizes)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row of docs (doc_id, text): null and empty texts get what the bias gives, repeated rows
    the same score, an empty table no rows; other columns do not matter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # ``features`` n-grams and weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        of_word = WordFeatures(m.grams, m.sizes)
        for b in batches:
            z = np.array([m.bias + m.weights[text_features(t, of_word)].sum() for t in string_list(b["text"])])
            yield pd.DataFrame({"doc_id": exact_longs(b), "score": 1 / (1 + np.exp(-np.clip(z, -700, 700)))})

    return docs.select(*exact(), "text").mapInPandas(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose text scores below the threshold. Rows pass through Arrow, which keeps every value."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        of_word = WordFeatures(m.grams, m.sizes)
        for b in batches:
            z = np.array([m.bias + m.weights[text_features(t, of_word)].sum() for t in string_list(b.column("text").to_pylist())], float)
            yield b.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))) < threshold))

    return docs.mapInArrow(run, docs.schema)
