"""Language identification by Bayesian fusion of several kinds of evidence.

log P(l | all) = c + temper * log P(text | l) + log P(declared | l) + log P(l | host). Text likelihoods
come from byte trigrams. How far declared languages can be trusted comes from grouped counts over the rows
that the text model was not fitted on (a quarter of them, by a hash of the id), and the priors of hosts
from grouped counts over all rows. A host's prior is smoothed towards that of its address suffix, and
that one towards the corpus. ``page_evidence`` gives the evidence that raw web pages hold.

One more hypothesis, "none of these", has a log likelihood a trigram that depends on the language whose
model explains the text best: half-way between what texts of that language have under its model and
what texts of other languages have under it where it is their second best, which tells how a text of a
language without a model would look. It is never less than that of the uniform trigram model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import exact, exact_longs, few, row_key, string_list, written

BUCKETS = 1 << 15
UNIFORM = -float(np.log(BUCKETS))
CODE = r"^[A-Za-z]{2,3}([-_][A-Za-z0-9]{2,8})*$"


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the letters and gaps of a text; digits and signs are gaps, case does not matter."""
    data = text.lower().encode()
    a = np.frombuffer(data, np.uint8)
    letter = (a >= 0x80) | ((a >= 97) & (a <= 122))
    a = np.where(letter, a, 32)
    a = a[letter | np.r_[True, letter[:-1]]] if len(a) else a  # one gap for a run of them
    if not letter.any():
        return np.empty(0, np.int64)
    a = np.r_[32, a, 32].astype(np.int64)
    return ((a[:-2] * 31 + a[1:-1]) * 1021 + a[2:] * 7) % BUCKETS


def suffix_of(host: Column) -> Column:
    """What follows the last dot of a host; empty where there is none."""
    return F.coalesce(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit(""))


def page_evidence(pages: DataFrame) -> DataFrame:
    """doc_id, text, lang, source of pages (page_id, url, html): the text between tags, the language that the markup declares
    (its primary part in lower case; null if none) and the url's host (null where there is no ://)."""
    html = F.coalesce("html", F.lit(""))
    shown = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    said = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z]+)""", 1))
    host = F.regexp_extract("url", r"(?s)\A.*?://([^/?#:]*)", 1)
    some = lambda c: F.when(c != "", c)
    return pages.select(F.col("page_id").alias("doc_id"), shown.alias("text"), some(said).alias("lang"), some(F.lower(host)).alias("source"))


def apart() -> Column:
    """Rows kept out of the fit of the text model: those without an id and a quarter of the others."""
    return F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0, F.lit(True))


def fit_text(docs: DataFrame, languages: list[str], declared: str, most: int) -> np.ndarray:
    """log P(trigram | language), a row per language, from a bounded sample of rows that declare one of them and are not set apart."""
    chosen = docs.filter(F.col(declared).isin(languages) & ~apart()).select("doc_id", F.col(declared).alias("l"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "l")  # <= most rows broadcast
    number = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for b in batches:
            for text, x in zip(string_list(b["text"]), b["l"], strict=True):
                np.add.at(total[number[x]], trigrams(text), 1)
        at, gram = np.nonzero(total)
        yield pd.DataFrame({"l": at, "gram": gram, "n": total[at, gram]})

    counted = sample.mapInPandas(run, "l int, gram int, n long").groupBy("l", "gram").agg(F.sum("n").alias("n")).toPandas()
    total = np.full((len(languages), BUCKETS), 0.5)  # the table's size is fixed
    total[counted["l"].to_numpy(int), counted["gram"].to_numpy(int)] += counted["n"].to_numpy(float)
    return np.log(total / total.sum(axis=1, keepdims=True))


def text_evidence(docs: DataFrame, table: np.ndarray, declared: str, host: str) -> DataFrame:
    """row (key of the row's evidence and doc_id), doc_id, declared, host, grams (number of trigrams), loglik (one per language), best and second (best languages, from 1).

    ``second`` is 0 where there is one language only. Equal likelihoods go to the first language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for b in batches:
            grams, loglik = [], []
            for x in string_list(b["text"]):  # one text's trigrams at a time
                g = trigrams(x)
                grams.append(len(g)), loglik.append(t[g].sum(axis=0))
            order = np.argsort(-np.reshape(loglik, (len(b), t.shape[1])), axis=1, kind="stable") + 1
            second = order[:, 1] if t.shape[1] > 1 else 0
            yield b[["row", "declared", "host"]].assign(doc_id=exact_longs(b), grams=grams, loglik=loglik, best=order[:, 0], second=second)

    cols = docs.select(row_key("doc_id", "text", declared, host).alias("row"), *exact(), F.col(declared).cast("string").alias("declared"), F.col(host).cast("string").alias("host"), "text")
    return cols.mapInPandas(run, "row long, doc_id long, declared string, host string, grams long, loglik array<double>, best int, second int")


def background_levels(seen: DataFrame, k: int) -> np.ndarray:
    """Log likelihood a trigram of "none of these" for texts that each of the k languages explains best.

    Learnt from all rows that declare the language which explains them best, and better than the uniform
    model. Between a language's median text and its level are three spreads of its texts or more; the
    spread is the distance from the median to the upper sixth, which junk below does not widen. A
    language without such rows has no usable model: its level, 0, is above all texts.
    """
    own, other = F.get("loglik", F.col("best") - 1), F.get("loglik", F.col("second") - 1)
    good = seen.filter((F.col("grams") > 0) & (F.col("said") == F.col("best"))).withColumns({"own": own, "other": other}).filter(F.col("own") > UNIFORM * F.col("grams"))
    bins: list[list[tuple[int, int]]] = [[] for _ in range(k)]
    for r in good.groupBy("best", F.floor(F.col("own") / F.col("grams") * 100).alias("bin")).count().collect():  # about a thousand bins a language
        bins[r["best"] - 1].append((r["bin"], r["count"]))
    away = np.full(k, UNIFORM)
    for r in good.filter("second > 0").groupBy("second").agg((F.sum("other") / F.sum("grams")).alias("mean")).collect():  # at most k rows
        away[r["second"] - 1] = max(UNIFORM, r["mean"])
    level = np.zeros(k)
    for i in range(k):
        if bins[i]:
            value, n = np.array(sorted(bins[i])).T
            middle, upper = (value[np.searchsorted(n.cumsum(), share * n.sum())] / 100 for share in (1 / 2, 5 / 6))
            level[i] = max(UNIFORM, min((middle + away[i]) / 2, middle - 3 * (upper - middle)))
    return level


def identify(docs: DataFrame, languages: list[str] | None = None, declared: str = "lang", host: str = "source", **how) -> DataFrame:
    """What ``judged`` finds, without the key."""
    return judged(docs, languages, declared, host, **how).drop("row")


def keep_identified(docs: DataFrame, languages: list[str] | None = None, declared: str = "lang", host: str = "source", small: int = 250_000, **how) -> DataFrame:
    """The rows of docs, all columns, that are kept. Rows with equal ids, null ones too, are judged one by one.

    Keys of rejected rows are broadcast up to ``small`` of them, so that texts are not shuffled; beyond that
    they are joined by a shuffle.
    """
    gone = written(judged(docs, languages, declared, host, **how).filter("not kept").select(F.col("row").alias("_gone")).distinct())
    return docs.join(few(gone, small), row_key("doc_id", "text", declared, host) == F.col("_gone"), "left_anti")


def judged(
    docs: DataFrame, languages: list[str] | None = None, declared: str = "lang", host: str = "source",
    temper: float = 0.3, strength: float = 20.0, least: float = 0.5, most: int = 8_000, share: float = 1 / 128,
) -> DataFrame:
    """row, doc_id, language, posterior, text_language, kept: a row for every row of docs.

    ``languages``, which get a text model, default to those that at least ``share`` of the declaring rows declare, of which there
    can be 1 / share at most; if none is declared so often, to the 1 / share most declared ones. A row that declares
    another language, by something that looks like a language's code, is of that language if its text is "none of these":
    no language is rejected because it is rare. Where ``languages`` are given, all others are "none of these". The text model is fitted on at most ``most``
    rows, the first by a hash of doc_id. Kept are rows with a letter
    whose best language has a posterior of ``least`` or more; a text without letters, or whose best
    hypothesis is "none of these" and that declares no other language, is "und" and not kept. Null declarations and hosts are no evidence;
    unknown declarations count as one other value. Ties go to the first language by name. Repeated rows are
    judged alike, an empty table gives no rows, and other columns of docs do not matter.
    """
    given = languages is not None
    if not given:
        named = docs.filter(f"trim({declared}) <> ''").groupBy(declared).count()
        enough, most_named = share * (named.agg(F.sum("count")).first()[0] or 0), int(1 / share)
        often = named.filter(F.col("count") >= enough).collect() or named.orderBy(F.desc("count"), declared).limit(most_named).collect()
        languages = sorted(r[0] for r in often)  # 1 / share rows at most
    if not languages:
        return docs.select(row_key("doc_id", "text", declared, host).alias("row"), F.col("doc_id").cast("long"), F.lit("und").alias("language"), F.lit(0.0).alias("posterior"), F.lit("und").alias("text_language"), F.lit(False).alias("kept"))
    names, k = F.array(*map(F.lit, languages), F.lit("und")), len(languages) + 1  # the last one is "none of these"
    seen = written(text_evidence(docs, fit_text(docs, languages, declared, most), declared, host))
    seen = seen.withColumns({
        "suffix": suffix_of(F.col("host")),
        "said": F.when(F.col("declared").isin(languages), F.array_position(names, F.col("declared")).cast("int")).when(F.col("declared").isNotNull(), 0),
    })
    levels = F.array(*(F.lit(float(x)) for x in background_levels(seen, k - 1)))
    seen = seen.withColumn("loglik", F.concat("loglik", F.array(F.col("grams") * F.get(levels, F.col("best") - 1))))
    at_best = F.array_position("loglik", F.array_max("loglik")).cast("int")
    seen = seen.withColumn("best", F.when(F.col("grams") > 0, at_best))

    counts = seen.filter("best is not null").groupBy("suffix", "host", "best", "said", apart().alias("apart")).agg(F.count("*").alias("n"))
    counts = written(counts)
    trust = np.ones((k, k))  # rows: declared (0 other), columns: language of the text
    root = np.ones(k)
    for r in counts.groupBy("best", "said").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("apart"), F.col("n")).otherwise(0)).alias("apart")).collect():  # at most languages squared
        root[r["best"] - 1] += r["n"]
        if r["said"] is not None:
            trust[r["said"], r["best"] - 1] += r["apart"]
    trust, root = np.log(trust / trust.sum(axis=0)), root / root.sum()

    of_language = [F.sum(F.when(F.col("best") == i + 1, F.col("n")).otherwise(0)).alias(f"_{i}") for i in range(k)]
    counted = lambda by: counts.filter(F.col(by[-1]).isNotNull()).groupBy(*by).agg(F.sum("n").alias("_n"), *of_language).select(*by, "_n", F.array(*(F.col(f"_{i}") for i in range(k))).alias("_own"))
    smooth = lambda parent: F.zip_with("_own", parent, lambda x, p: (x + strength * p) / (F.col("_n") + strength))
    base = F.array(*(F.lit(float(x)) for x in root))
    by_suffix = counted(["suffix"]).select("suffix", smooth(base).alias("of_suffix"))
    by_host = counted(["suffix", "host"]).join(by_suffix, "suffix").select("host", smooth(F.col("of_suffix")).alias("prior"))

    logs = F.array(*(F.array(*map(F.lit, map(float, row))) for row in trust))
    said = F.element_at(logs, F.col("said") + 1)
    joined = seen.join(by_host, "host", "left")
    total = F.transform(
        F.col("loglik"),
        lambda x, i: x * temper + F.coalesce(F.get(said, i), F.lit(0.0)) + F.log(F.get(F.coalesce(F.col("prior"), base), i)),
    )
    top = F.array_max("total")
    scored = joined.withColumn("total", total).select(
        "row", "doc_id", "grams", "declared", F.element_at(names, F.array_position("total", top).cast("int")).alias("language"),
        (1 / F.aggregate(F.transform("total", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)).alias("posterior"),
        F.element_at(names, F.col("best")).alias("text_language"),
    )
    some = F.col("grams") > 0
    rare = F.lit(False) if given else F.coalesce(~F.col("declared").isin(languages) & (F.lower("declared") != "und") & F.col("declared").rlike(CODE), F.lit(False))
    scored = scored.withColumn("language", F.when((F.col("language") == "und") & rare, F.col("declared")).otherwise(F.col("language")))
    return scored.select(
        "row", "doc_id", F.when(some, F.col("language")).otherwise("und").alias("language"), F.when(some, F.col("posterior")).otherwise(0.0).alias("posterior"),
        F.coalesce("text_language", F.lit("und")).alias("text_language"), (some & (F.col("language") != "und") & (F.col("posterior") >= least)).alias("kept"),
    )
