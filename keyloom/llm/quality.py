"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the languages at hand.
STOP_WORDS = {
    "en": "the of and to in is that for it with as was on are by this be from at an or",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au avec elle il",
    "es": "de la que el en y a los se del las un por con una su para es al lo no",
}
BLANK = " \\t-\\r"


@dataclass(frozen=True)
class Rule:
    """A measure with its least and greatest allowed value; None: no bound on that side."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Thresholds of the public web-text filters, wide enough for short and for tabular texts.
RULES = (
    Rule("length", "n_words", 10, 100_000),
    Rule("mean_word", "mean_word_chars", 2, 15),
    Rule("symbols", "symbol_ratio", None, 0.3),
    Rule("stop_words", "stop_word_ratio", 0.01, None),
    Rule("dup_lines", "dup_line_ratio", None, 0.3),
    Rule("repeats", "repeat_word_ratio", None, 0.2),
    Rule("bullets", "bullet_line_ratio", None, 0.9),
    Rule("ellipses", "ellipsis_line_ratio", None, 0.3),
    Rule("alphabetic", "alpha_word_ratio", 0.6, None),
)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where it is used inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, window: int = 5) -> Column:
    """Number of words that lie in a window of so many words found twice or more (the first included).

    Windows are hashed and sorted; equal neighbours give the repeated starts, whose windows' union is
    added up. n log n in the words of a text.
    """

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1), F.lit(2**30)) - x))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(pairs: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(pairs, i)["h"] == x["h"], F.lit(False))
        twice = F.filter(pairs, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def hashed(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(w) - (window - 1))
        one = lambda i: F.struct(F.xxhash64(*(F.element_at(w, i + k) for k in range(window))).alias("h"), i.alias("i"))
        return let(F.sort_array(F.transform(at, one)), repeated)

    return F.when(F.size(words) >= window, let(words, hashed)).otherwise(F.lit(0)).cast("long")


def measures(text: Column, stop_words: dict[str, str] = STOP_WORDS) -> dict[str, Column]:
    """Columns over the whole text: counts first, ratios after. Null counts as the empty text."""
    text = F.coalesce(text, F.lit(""))
    stops = sorted({w for ws in stop_words.values() for w in ws.split()})
    count = lambda a, test: F.size(F.filter(a, test)).cast("long")

    words = F.filter(F.split(text, f"[{BLANK}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
            count(w, lambda x: F.lower(x).isin(*stops)).alias("n_stop_words"),
            count(w, lambda x: x.rlike("\\p{L}")).alias("n_alpha_words"),
        )

    def of_lines(a: Column) -> Column:
        return F.struct(
            F.size(a).cast("long").alias("n_lines"),
            (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
            count(a, lambda x: x.rlike(f"^[{BLANK}]*[-*•]")).alias("n_bullet_lines"),
            count(a, lambda x: x.rlike(f"(\\.\\.\\.|…)[{BLANK}]*$")).alias("n_ellipsis_lines"),
        )

    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long")
    return {"w": let(words, of_words), "l": let(lines, of_lines), "n_symbols": symbols}


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """docs with a struct ``quality``: the counts, the ratios, ``failed`` (names of broken rules) and ``kept``.

    Each row is judged by itself, so repeated rows, ties and extra columns do not matter; a text without
    words has ratios of 0 and breaks the length rule.
    """
    m = measures(F.col(text))

    def judged(x: Column) -> Column:
        c = {k: x["w"][k] for k in ("n_words", "word_chars", "n_repeat_words", "n_stop_words", "n_alpha_words")}
        c |= {k: x["l"][k] for k in ("n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines")}
        c["n_symbols"] = x["n_symbols"]
        ratio = lambda a, b: F.coalesce(F.try_divide(c[a].cast("double"), c[b].cast("double")), F.lit(0.0))
        c |= {
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "word_chars"),
            "stop_word_ratio": ratio("n_stop_words", "n_words"),
            "alpha_word_ratio": ratio("n_alpha_words", "n_words"),
            "repeat_word_ratio": ratio("n_repeat_words", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "bullet_line_ratio": ratio("n_bullet_lines", "n_lines"),
            "ellipsis_line_ratio": ratio("n_ellipsis_lines", "n_lines"),
        }
        return let(F.struct(*(v.alias(k) for k, v in c.items())), broken)

    def broken(c: Column) -> Column:
        tests = []
        for r in rules:
            bad = F.lit(False)
            if r.least is not None:
                bad = bad | (c[r.measure] < F.lit(r.least))
            if r.most is not None:
                bad = bad | (c[r.measure] > F.lit(r.most))
            tests.append(F.when(bad, r.name))
        failed = F.filter(F.array(*tests), lambda x: x.isNotNull())
        return F.struct(c.alias("counts"), failed.alias("failed"), (F.size(failed) == 0).alias("kept"))

    return docs.withColumn("quality", let(F.struct(*(v.alias(k) for k, v in m.items())), judged))


def rule_report(docs: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, counts, base_failed and kept."""
    q = assess(docs.select("doc_id", "text"))
    c = {k: F.col("quality.counts")[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    base = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    return q.select(
        "doc_id", *(v.alias(k) for k, v in c.items()), base.alias("base_failed"),
        (~base & F.col("quality.kept")).alias("kept"), F.concat_ws(",", "quality.failed").alias("failed_rules"),
    )
