"""Token counts without ids: pieces once per distinct pre-token, joined to per-document frequencies.

The corpus's distinct pre-tokens are counted first and each is given its number of pieces once. The
``head`` most frequent of them, whatever their length, travel to the tasks as a lookup, in which long ones
stand as digests so that its bytes are bounded too; frequencies of all the others join the table of pieces
by a shuffle on the pre-token. So hot pre-tokens never meet in one task: one of the tail makes up at most
1 / ``head`` of all occurrences.
"""

from __future__ import annotations

import hashlib
import os
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.bpe import slices
from keyloom.llm.common import exact, exact_longs, row_ids, string_list, written
from keyloom.llm.pretokens import pretokens, special_cutter, special_ids


def frequencies(tokenizer_path: str):
    """text -> (number of special strings, Counter of its pre-tokens)."""
    parts = special_cutter(special_ids(tokenizer_path))

    def of(text: str) -> tuple[int, Counter]:
        cut = parts(text)
        if len(cut) == 1 and not cut[0][1]:
            return 0, Counter(pretokens(text))
        words = Counter(w for p, special in cut if not special for w in pretokens(p))
        return sum(special for _, special in cut), words

    return of


def pretoken_table(docs: DataFrame, tokenizer_path: str, held: int = 200_000) -> DataFrame:
    """pretoken, n (occurrences in all texts), pieces: a row per distinct pre-token.

    A task adds up at most ``held`` pre-tokens before it passes them on.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, total = frequencies(tokenizer_path), Counter()
        for b in batches:
            for text in string_list(b["text"]):
                total.update(of(text)[1])
                if len(total) > held:
                    yield pd.DataFrame({"pretoken": list(total), "n": list(total.values())})
                    total = Counter()
        yield pd.DataFrame({"pretoken": list(total), "n": list(total.values())}, columns=["pretoken", "n"]).astype({"pretoken": str, "n": "int64"})

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has its own core only
        from tokenizers import Tokenizer

        encode = Tokenizer.from_file(tokenizer_path).encode_batch_fast
        for b in batches:
            pieces: list[int] = []
            words = b["pretoken"].to_list()
            for lo, hi in slices(words, 500_000):
                pieces += [len(e) for e in encode(words[lo:hi], add_special_tokens=False)]
            yield b.assign(pieces=pieces)

    counted = docs.select("text").mapInPandas(count, "pretoken string, n long")
    distinct = counted.groupBy("pretoken").agg(F.sum("n").alias("n"))
    return distinct.mapInPandas(split, "pretoken string, n long, pieces long")


def most_frequent(table: DataFrame, head: int, longest: int) -> dict[str | bytes, int]:
    """Pieces of the ``head`` most frequent pre-tokens, by the pre-token, or its SHA-256 if it has more than ``longest`` characters."""
    short = F.length("pretoken") <= longest
    keys = table.select("n", "pieces", F.when(short, F.col("pretoken")).alias("short"), F.when(~short, F.unhex(F.sha2(F.col("pretoken").cast("binary"), 256))).alias("digest"))
    top = keys.orderBy(F.desc("n"), "short", "digest").limit(head).toArrow()
    return {s if s is not None else d: p for s, d, p in zip(*(top[c].to_pylist() for c in ("short", "digest", "pieces")), strict=True)}


def token_counts(docs: DataFrame, tokenizer_path: str, head: int = 131_072, longest: int = 32) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of docs (doc_id, text; other columns do not matter).

    Null counts as the empty text: 0 bytes, 0 tokens. Repeated rows give a row each. Special strings in
    a text count as one token, the tokenizers library's default. An empty table gives no rows. The lookup
    holds the ``head`` most frequent pre-tokens; those of more than ``longest`` characters are known there by
    their SHA-256.
    """
    table = written(pretoken_table(docs, tokenizer_path))
    lookup = docs.sparkSession.sparkContext.broadcast(most_frequent(table, head, longest))

    def known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, get, ids = frequencies(tokenizer_path), lookup.value.get, row_ids()
        for b in batches:
            row, doc, size, word, n = [], [], [], [], []
            for d, text in zip(exact_longs(b).to_list(), string_list(b["text"]), strict=True):
                total, words = of(text)
                r = next(ids)
                for w, k in words.items():
                    pieces = get(w if len(w) <= longest else hashlib.sha256(w.encode()).digest())
                    if pieces is not None:
                        total += k * pieces
                    else:
                        row.append(r), doc.append(None), size.append(None), word.append(w), n.append(k)
                # the document's own row; no pre-token looks like its key, so these rows spread evenly
                row.append(r), doc.append(d), size.append(len(text.encode())), word.append(f"\0{r}"), n.append(total)
            yield pd.DataFrame({"row": row, "doc_id": pd.array(doc, "Int64"), "n_bytes": pd.array(size, "Int64"), "pretoken": word, "n": n})

    parts = docs.select(*exact(), "text").mapInPandas(known, "row long, doc_id long, n_bytes long, pretoken string, n long")
    joined = parts.join(table.select("pretoken", "pieces"), "pretoken", "left")
    return (
        joined.groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens")
    )
