"""Best-fit packing of token sequences into fixed-length training sequences.

Bulk-synchronous best-fit over size classes. Lengths are integers up to ``capacity``, so documents and
gaps, range-sorted by size, fall into at most ``capacity`` classes whatever the number of rows. Each
superstep takes the largest class of documents left, sweeps to the successor class of gaps (the
smallest that takes it), matches rank with rank until the documents or those gaps run out, updates the
gaps and repeats. A superstep touches classes and rank intervals, never rows; Spark then gives every
piece its rank within its length (counts per input partition, summed by a window, and the row number
inside the partition) and each piece finds its interval. The outcome equals best-fit decreasing.
"""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.bpe import token_bytes
from keyloom.llm.common import exact, exact_longs, row_ids, string_list, written
from keyloom.llm.pretokens import PATTERN, SPACE, special_cutter

LONGEST_RUN = 100_000
LONG_SPACE = re.compile(f"[{SPACE}]{{{LONGEST_RUN},}}")
PIECES = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long"


@functools.cache
def encoder(tokenizer_path: str):
    """text -> ids as little-endian uint32 bytes, as the tokenizers library gives them without added tokens.

    Ids are merge ranks here, so tiktoken, which is several times faster, gives the same ones. Its split
    pattern cannot look ahead over very long white space, so such runs are cut out before: one is a
    pre-token of its own up to the last character, which stays with what follows.
    """
    import tiktoken

    id_of, special = token_bytes(tokenizer_path)
    one = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=id_of, special_tokens=special)
    encode, specials, parts = one.encode_ordinary, set(special), special_cutter(special)

    def cut(text: str) -> bytes:
        out, at = array("I"), 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            out.extend(encode(text[at : run.start()]))
            out.extend(one._encode_single_piece(text[run.start() : end]))
            at = end
        out.extend(encode(text[at:]))
        return out.tobytes()

    def ids(text: str) -> bytes:
        if len(text) >= LONGEST_RUN and LONG_SPACE.search(text):
            return b"".join(array("I", [special[p]]).tobytes() if is_special else cut(p) for p, is_special in parts(text))
        if any(s in text for s in specials):
            return array("I", one.encode(text, allowed_special=specials)).tobytes()
        return array("I", encode(text)).tobytes()

    return ids


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: row_id, doc_id, piece, start, length, ids_crc32.

    A document is its ids and then ``end_id``; one longer than ``capacity`` is cut into pieces of
    ``capacity`` tokens of which only the first may be shorter. A null or empty text is the end id alone.
    Only doc_id and text are read; other columns do not matter.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, ids = encoder(tokenizer_path), row_ids()
        end = np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            rows = []
            for doc, text in zip(exact_longs(b).to_list(), string_list(b["text"]), strict=True):
                data = encode(text) + end
                total = len(data) // 4
                first = total % capacity or capacity
                start, length = 0, min(first, total)
                piece = 0
                while start < total:
                    rows.append((next(ids), doc, piece, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
                    start, length, piece = start + length, capacity, piece + 1
            out = pd.DataFrame(rows, columns=["row_id", "doc_id", "piece", "start", "length", "ids_crc32"], dtype=object)
            yield out.astype({"doc_id": "Int64"} | dict.fromkeys(out.columns.drop("doc_id"), "int64"))

    return docs.select(*exact(), "text").mapInPandas(run, PIECES)


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[pd.DataFrame, int]:
    """Rank intervals of each length and where they go, and the number of sequences.

    Interval rows (length, lo, sequence, per, offset): the piece of that length with rank r goes to
    sequence + (r - lo) // per, at offset + (r - lo) % per * length. The number of rows depends on
    ``capacity`` alone. Runs of sequences with the same gap are kept as (first sequence, count).
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences
    opened = 0
    rows: list[tuple[int, int, int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        fitting = [g for g in gaps if g >= length and gaps[g]]
        heapq.heapify(fitting)  # successor sweep: smallest gap that takes this length first
        while left:
            while fitting and not gaps[fitting[0]]:
                heapq.heappop(fitting)
            if fitting:
                gap = fitting[0]
                first, n = gaps[gap].pop()
            else:
                gap, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            per = gap // length
            full = min(n, left // per)
            if full:
                rows.append((length, rank, first, per, capacity - gap))
                rank, left = rank + full * per, left - full * per
                gaps[gap - per * length].append((first, full))
            if full < n:
                if left:
                    rows.append((length, rank, first + full, left, capacity - gap))
                    gaps[gap - left * length].append((first + full, 1))
                    rank, left, full = rank + left, 0, full + 1
                if full < n:
                    gaps[gap].append((first + full, n - full))
    return pd.DataFrame(rows, columns=["length", "lo", "sequence", "per", "offset"]), opened


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to pieces (row_id unique, length from 1 to capacity).

    Equal lengths are told apart by rank alone, so ties and repeated rows need no order. An empty input
    gives an empty result. ``pieces`` should be materialised: it is read three times.
    """
    pieces = pieces.withColumn("_part", F.shiftright("row_id", 20))  # of one task, a million rows at most
    per_part = pieces.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    plan, _ = best_fit_plan(counts, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(  # its size depends on capacity alone
        {int(k): tuple(v[c].to_numpy() for c in ("lo", "sequence", "per", "offset")) for k, v in plan.groupby("length")}
    )
    local = Window.partitionBy("_part", "length").orderBy("row_id")
    ranked = pieces.withColumn("_local", F.row_number().over(local) - 1).join(starts, ["_part", "length"])
    ranked = ranked.withColumn("_rank", F.col("_local") + F.col("_start")).drop("_part", "_local", "_start", "row_id")
    keep = [f for f in ranked.schema.fields if f.name != "_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = shared.value
        for b in batches:
            rank, length = b.column("_rank").to_numpy(zero_copy_only=False), b.column("length").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                lo, first, per, base = by_length[int(one)]
                k = np.searchsorted(lo, rank[at], side="right") - 1
                r = rank[at] - lo[k]
                sequence[at], offset[at] = first[k] + r // per[k], base[k] + r % per[k] * one
            own = [b.column(n) for n in b.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sequence), pa.array(offset)], [*(n for n in b.schema.names if n != "_rank"), "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*keep, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of every document."""
    pieces = written(token_pieces(docs, tokenizer_path, capacity))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(pieces, capacity).select(*cols)
