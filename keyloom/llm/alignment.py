"""Alignment of the tokens of two tokenizers, and how many documents link each pair of their ids.

Pass one cuts the documents into chunks, aligns them, and writes for every chunk its distinct pairs with
the number of its documents that hold them. Pairs are dealt to shards by a hash; a shard gets a minimal
perfect hash of its distinct pairs. Tasks add the chunks' numbers into dense vectors indexed by it, and
the vectors are summed shard by shard as a tree. Every lookup compares the key that stands in the slot.
Pass two gives each chunk the counts of its pairs, aligns its documents again and looks them up.

Rows between tasks hold packed arrays of many pairs; what a task holds is bounded by the sizes of a
chunk and of a shard, whatever the number of documents.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.bpe import token_bytes
from keyloom.llm.common import by_group, exact, exact_longs, string_list, written
from keyloom.llm.packing import LONG_SPACE, LONGEST_RUN
from keyloom.llm.perfect_hash import CountTable, PerfectHash, mixed
from keyloom.llm.pretokens import PATTERN

#: No token of either tokenizer goes over a blank between two characters that are not white space.
SEAM = re.compile(r"(?<=[^\s▁]) (?=\S)")
FAN_IN = 16  # vectors that one task of the tree sums


class Tokenizers:
    """Ids, sizes and printed forms of a byte-level vocabulary (A) and a piece model (B)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        id_of, _ = token_bytes(a_path)
        self.one = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=id_of, special_tokens={})
        self.a_bytes = [b""] * (1 + max(id_of.values()))
        for data, i in id_of.items():
            self.a_bytes[i] = data
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        #: Texts may be cut at seams: pieces have their blanks in front, and one is put before every text.
        self.seams = not any("▁" in p.lstrip("▁") for p in names) and self.pieces.encode("a", out_type=str)[0].startswith("▁")
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (np.array([[f"{i}," for i in range(len(x))], [f"{i}{end}" for i in range(len(x))]], object) for x, end in ((self.a_bytes, "|"), (self.b_bytes, ";")))

    def a_ids(self, text: str) -> list[int]:
        """Ids of a text in which special strings mean nothing; the split pattern does not look ahead over very long white space."""
        encode = self.one.encode_ordinary
        if len(text) < LONGEST_RUN or not LONG_SPACE.search(text):
            return encode(text)
        out, at = [], 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += encode(text[at : run.start()])
            out += self.one._encode_single_piece(text[run.start() : end])
            at = end
        return out + encode(text[at:])

    def both(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both for texts that are not empty, and how many each text has; none where joined tokens are not the text with a blank before it.

        Texts with seams between them are encoded as one, up to 256 of them.
        """
        joins = list(map(self.joins, texts))
        cuts = [0, *(i for i in range(1, len(texts)) if i % 256 == 0 or not (joins[i - 1] and joins[i])), len(texts)]
        runs = [self.run(texts[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        a, n_a, b, n_b = (np.concatenate([np.empty(0, np.int64), *(r[i] for r in runs)]) for i in range(4))
        return a, b, n_a, n_b

    def joins(self, text: str) -> bool:
        """A seam stands before and after such a text, if its neighbour is such a text, too."""
        return self.seams and not (text[0].isspace() or text[-1].isspace() or text[-1] == "▁")

    def run(self, texts: list[str]) -> list[np.ndarray]:
        data, whole = [(" " + x).encode() for x in texts], " " + " ".join(texts)
        ends, out = np.cumsum(list(map(len, data))), []
        for ids, size_of, bytes_of in ((self.a_ids(whole), self.a_size, self.a_bytes), (self.pieces.encode(whole[1:]), self.b_size, self.b_bytes)):
            if b"".join(map(bytes_of.__getitem__, ids)) != b"".join(data):
                break
            flat = np.array(ids, np.int64)
            until = np.searchsorted(np.cumsum(size_of[flat]), ends, side="right")
            out += [flat, np.diff(until, prepend=0)]
        else:
            return out
        if len(texts) == 1:
            return [np.empty(0, np.int64), np.zeros(1, np.int64)] * 2
        half = len(texts) // 2  # look for those that are not given back
        return [np.concatenate(x) for x in zip(self.run(texts[:half]), self.run(texts[half:]), strict=True)]


@functools.cache
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


@functools.cache
def segments(a_path: str, b_path: str) -> Segments:
    return Segments(tokenizers(a_path, b_path))


@dataclass
class Aligned:
    """Alignment of some texts: ids, where groups end, and the links in order, each with its text's number."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    a_closes: np.ndarray
    b_closes: np.ndarray
    keys: np.ndarray
    of: np.ndarray

    def groups(self, t: Tokenizers) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        a_group, b_group = np.cumsum(self.a_closes) - self.a_closes, np.cumsum(self.b_closes) - self.b_closes
        a_until, b_until = np.flatnonzero(self.a_closes) + 1, np.flatnonzero(self.b_closes) + 1  # tokens up to a group's end
        out = np.empty(len(self.a) + len(self.b), object)
        out[np.arange(len(self.a)) + np.r_[0, b_until][a_group]] = t.a_text[self.a_closes.astype(int), self.a]
        out[np.arange(len(self.b)) + a_until[b_group]] = t.b_text[self.b_closes.astype(int), self.b]
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(out[hi - n : hi])[:-1] for hi, n in zip(ends, self.n_a + self.n_b, strict=True)]


def align_texts(texts: list[str], t: Tokenizers) -> Aligned:
    """Two tokens are linked where their bytes overlap. Between neighbouring ends of tokens of either side lies one link."""
    a, b, n_a, n_b = t.both(texts)
    a_end, b_end = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])
    ends = distinct(np.concatenate([a_end, b_end]))
    within = lambda x, y: y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x if len(y) else np.zeros(len(x), bool)
    keys = a[np.searchsorted(a_end, ends)] << 32 | b[np.searchsorted(b_end, ends)]
    return Aligned(a, b, n_a, n_b, within(a_end, b_end), within(b_end, a_end), keys, np.searchsorted(np.cumsum(sums(t.a_size[a], n_a)), ends))


class Segments(dict):
    """segment -> number, and the alignment of every segment; a text is cut into them at its seams.

    Words between single blanks are segments of their own unless white space or a low line is at one of their
    ends; a text that holds such a word is cut by ``SEAM``, and its segments have their blank in front.
    """

    def __init__(self, t: Tokenizers, most: int = 150_000, characters: int = 4_000_000):
        self.t, self.most, self.characters, self.corpus = t, most, characters, ""
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.groups: list[str] = []
        self.held = 0
        self.n_a = self.n_b = self.n_groups = self.keys = np.empty(0, np.int64)
        self.until = np.zeros(1, np.int64)  # where a segment's links begin; the next one's are its end
        self.weights = np.zeros((2, 0), np.int64)  # what the corpus' counts say of segments, once that is known: best links and the sum; -1 before

    def __missing__(self, segment: str) -> int:
        edges = segment[:1] + segment[-1:]
        if segment[:1] != " " and (not segment or edges[0].isspace() or edges[1].isspace() or edges[1] == "▁" or not self.t.seams):
            self[segment] = -1
        else:
            self[segment] = len(self.groups) + len(self.fresh)
            self.fresh.append(segment)
        return self[segment]

    def cut(self, text: str) -> list[int]:
        """Numbers of a text's segments."""
        if not text:
            return []
        numbers = list(map(self.__getitem__, text.split(" ")))
        if -1 in numbers:
            whole = " " + text
            at = [0, *(m.start() for m in SEAM.finditer(whole)), len(whole)] if self.t.seams else [0, len(whole)]
            numbers = [self[whole[i:j]] for i, j in zip(at, at[1:], strict=False)]
        return numbers

    def settle(self, printed: bool) -> None:
        """Align the segments met for the first time; their groups as text only if ``printed``."""
        if not self.fresh:
            return
        x = align_texts([s.removeprefix(" ") for s in self.fresh], self.t)
        self.groups += x.groups(self.t) if printed else [""] * len(self.fresh)
        self.held += sum(map(len, self.fresh))
        self.fresh = []
        closes = np.bincount(np.repeat(np.arange(len(x.n_a)), x.n_a)[x.a_closes], minlength=len(x.n_a))
        for name, more in (("n_a", x.n_a), ("n_b", x.n_b), ("n_groups", closes), ("keys", x.keys), ("until", self.until[-1] + np.cumsum(np.bincount(x.of, minlength=len(x.n_a))))):
            setattr(self, name, np.concatenate([getattr(self, name), more]))

    def read(self, texts: list[str], printed: bool = True) -> Read:
        """Cut and align; what is known is forgotten before, if it is too much."""
        if len(self) > self.most or self.held > self.characters:
            self.forget()
        cut = list(map(self.cut, texts))
        self.settle(printed)
        n = np.array(list(map(len, cut)), np.int64)
        flat = np.fromiter(chain.from_iterable(cut), np.int64, n.sum())
        bad = sums(self.n_a[flat] == 0, n) > 0
        if bad.any():
            flat, n = flat[np.repeat(~bad, n)], np.where(bad, 0, n)
            cut = [[] if x else c for x, c in zip(bad, cut, strict=True)]
        return Read(cut, flat, n)

    def of_corpus(self, name: str) -> Segments:
        """Self, without what another corpus' counts say."""
        if self.corpus != name:
            self.corpus, self.weights = name, np.zeros((2, 0), np.int64)
        return self

    def weigh(self, x: Read, keys: np.ndarray, counts: np.ndarray, top: np.ndarray) -> None:
        """Best links and sum of counts of the segments of x that have none yet. keys, ascending, and counts: of all pairs in these texts; they are the corpus'."""
        self.weights = np.pad(self.weights, ((0, 0), (0, len(self.groups) - self.weights.shape[1])), constant_values=-1)
        new = distinct(x.flat[self.weights[1, x.flat] < 0])
        at, place = self.links(new)
        pairs, n = self.keys[at], counts[:0]
        if len(at):
            n = counts[np.searchsorted(keys, pairs)]
        size = self.until[new + 1] - self.until[new]
        self.weights[:, new] = sums(n == top[pairs >> 32], size), sums(n, size)

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``keys`` of the links of these segments, and which of the numbers each belongs to."""
        n = self.until[numbers + 1] - self.until[numbers]
        at = np.repeat(self.until[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return at, np.repeat(np.arange(len(numbers)), n)


@dataclass
class Read:
    """Segments of some texts: by text, all in order, and how many each text has; texts without an alignment have none."""

    cut: list[list[int]]
    flat: np.ndarray
    n: np.ndarray


def sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of n values."""
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values, ascending."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def portions(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many characters, or one text."""
    lo = size = 0
    for i, x in enumerate(texts):
        if size and size + len(x) > most:
            yield lo, i
            lo, size = i, 0
        size += len(x)
    if lo < len(texts):
        yield lo, len(texts)


def summed(keys: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their numbers."""
    known, at = np.unique(np.concatenate(keys or [np.empty(0, np.int64)]), return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, at, np.concatenate(numbers or [np.empty(0, np.int64)]))
    return known, total


def first_pass(docs: DataFrame, paths: tuple[str, str], chunk: int, portion: int) -> DataFrame:
    """Rows of documents (kind 1) and rows of pairs (kind 0: keys, n), both with the number of their chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        known, number, size = Segments(tokenizers(*paths)), TaskContext.get().partitionId() << 32, 0
        keys, numbers = [], []

        def pairs() -> pd.DataFrame:
            k, n = summed(keys, numbers)
            keys.clear(), numbers.clear()
            return pd.DataFrame({"chunk": [number], "kind": [0], "doc_id": [0], "no_doc_id": [True], "text": [None], "keys": [k.tobytes()], "n": [n.tobytes()]})

        for batch in batches:
            texts = string_list(batch["text"])
            for lo, hi in portions(texts, portion):
                x = known.read(texts[lo:hi], printed=False)
                of = distinct(np.repeat(np.arange(len(x.n)), x.n) * len(known) + x.flat)  # a segment once a document
                document, segment = np.divmod(of, max(1, len(known)))
                at, place = known.links(segment)
                used, _ = known.links(distinct(segment))
                number_of = np.zeros(len(known.keys), np.int64)
                pairs_here, number_of[used] = np.unique(known.keys[used], return_inverse=True)
                held = distinct(document[place] * len(pairs_here) + number_of[at]) % max(1, len(pairs_here))  # a pair once a document
                n = np.bincount(held, minlength=len(pairs_here))
                keys.append(pairs_here[n > 0]), numbers.append(n[n > 0])
                if len(keys) > FAN_IN:
                    keys[:], numbers[:] = ([v] for v in summed(keys, numbers))
                yield batch.iloc[lo:hi].assign(text=texts[lo:hi], chunk=number, kind=1, keys=None, n=None)[["chunk", "kind", "doc_id", "no_doc_id", "text", "keys", "n"]]
                size += sum(map(len, texts[lo:hi]))
                if size >= chunk:
                    yield pairs()
                    number, size = number + 1, 0
        yield pairs()

    return docs.select(*exact(), "text").mapInPandas(run, "chunk long, kind int, doc_id long, no_doc_id boolean, text string, keys binary, n binary")


def longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def dealt(pairs: DataFrame, shards: int, salts: int) -> DataFrame:
    """The chunks' pairs, dealt to shards by a hash of the pair and to salts by the chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, keys, n in zip(batch["chunk"], batch["keys"], batch["n"], strict=True):
                keys, n = longs(keys), longs(n)
                shard = (mixed(keys, 1 << 20) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                some = [i for i in range(shards) if cuts[i] < cuts[i + 1]]
                parts = [order[cuts[i] : cuts[i + 1]] for i in some]
                salt = int(mixed(np.array([chunk]), 7)[0] % np.uint64(salts))
                yield pd.DataFrame({"shard": some, "salt": salt, "chunk": chunk, "keys": [keys[p].tobytes() for p in parts], "n": [n[p].tobytes() for p in parts]}).astype({"shard": "int64"})

    return pairs.mapInPandas(run, "shard long, salt long, chunk long, keys binary, n binary")


def grouped(df: DataFrame, keys: list[str], run, schema: str) -> DataFrame:
    """run(rows of a group) -> frames, group by group, in tasks sorted by the keys and ``kind`` if there is one."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in by_group(batches, keys):
            yield from run(g)

    return df.repartition(*keys).sortWithinPartitions(*keys, *(["kind"] if "kind" in df.columns else [])).mapInPandas(each, schema)


def tree(df: DataFrame, salts: int, combine) -> DataFrame:
    """Rows (shard, salt, keys) combined by shard, at most ``FAN_IN`` a task and round, until one is left."""

    def run(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"shard": [g["shard"].iloc[0]], "salt": [g["salt"].iloc[0]], "keys": [combine(map(longs, g["keys"])).tobytes()]})

    while salts > 1:
        df, salts = grouped(df.withColumn("salt", F.expr(f"salt div {FAN_IN}")), ["shard", "salt"], run, "shard long, salt long, keys binary"), -(-salts // FAN_IN)
    return df


def union(parts: Iterator[np.ndarray], most: int = 1 << 22) -> np.ndarray:
    """Distinct values, ascending; no more than ``most`` are held beside those known."""
    known, held, size = np.empty(0, np.int64), [], 0
    for p in parts:
        held.append(p)
        size += len(p)
        if size > most:
            known, held, size = np.unique(np.concatenate([known, *held])), [], 0
    return np.unique(np.concatenate([known, *held]))


def vector_sum(parts: Iterator[np.ndarray]) -> np.ndarray:
    total = next(parts).copy()
    for p in parts:
        total += p
    return total


def count_tables(requests: DataFrame, shards: int, salts: int) -> DataFrame:
    """shard, sizes, bits, keys, counts: for every shard the perfect hash of its pairs and how many documents hold each."""

    def distinct(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"shard": [g["shard"].iloc[0]], "salt": [g["salt"].iloc[0]], "keys": [union(map(longs, g["keys"])).tobytes()]})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for shard, data in zip(b["shard"], b["keys"], strict=True):
                h, keys = PerfectHash.build(longs(data)), longs(data)
                yield pd.DataFrame({"shard": [shard], "sizes": [h.sizes], "bits": [h.packed], "keys": [keys[np.argsort(h.slots(keys))].tobytes()]})

    def count(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        first, rest = g.iloc[0], g.iloc[1:]
        table = CountTable(first["sizes"], first["bits"], longs(first["keys"]), np.zeros(len(first["keys"]) // 8, np.int64))
        for keys, n in zip(map(longs, rest["keys"]), map(longs, rest["n"]), strict=True):
            slots, known = table.verified(keys)
            if not known.all():
                raise ValueError("a pair has no slot of its own")
            table.counts[slots] += n  # a chunk has a pair once
        yield pd.DataFrame({"shard": [first["shard"]], "salt": [first["salt"]], "keys": [table.counts.tobytes()]})

    partial = grouped(requests.select("shard", "salt", "keys"), ["shard", "salt"], distinct, "shard long, salt long, keys binary")
    hashes = written(tree(partial, salts, union).select("shard", "keys").mapInPandas(build, "shard long, sizes array<long>, bits binary, keys binary"))
    vectors = grouped(beside(hashes, requests, salts), ["shard", "salt"], count, "shard long, salt long, keys binary")
    summed_up = tree(vectors, salts, vector_sum).select("shard", F.col("keys").alias("counts"))
    return written(hashes.join(summed_up, "shard"))


def beside(tables: DataFrame, requests: DataFrame, salts: int) -> DataFrame:
    """Every shard's table as the first row (kind 0) of each of its salts, its requests after it."""
    everywhere = tables.withColumns({"salt": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))), "kind": F.lit(0)})
    return everywhere.unionByName(requests.withColumn("kind", F.lit(1)), allowMissingColumns=True)


def replies(tables: DataFrame, requests: DataFrame, salts: int) -> DataFrame:
    """chunk, keys, n: how many documents of the corpus hold each pair of a chunk."""

    def run(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        first, rest = g.iloc[0], g.iloc[1:]
        table = CountTable(first["sizes"], first["bits"], longs(first["keys"]), longs(first["counts"]))
        if len(rest):
            yield pd.DataFrame({"chunk": rest["chunk"].astype("int64").to_numpy(), "keys": rest["keys"].to_numpy(), "n": [table.get(longs(k)).tobytes() for k in rest["keys"]]})

    # pandas makes doubles of longs with nulls: a table's row has chunk 0
    rows = beside(tables, requests.drop("n"), salts).withColumn("chunk", F.coalesce("chunk", F.lit(0).cast("long")))
    return grouped(rows, ["shard", "salt"], run, "chunk long, keys binary, n binary")


def best_counts(tables: DataFrame) -> dict[int, int]:
    """The highest count of every A id that is linked; there are at most as many as the vocabulary has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for keys, counts in zip(map(longs, b["keys"]), map(longs, b["counts"]), strict=True):
                a, at = np.unique(keys >> 32, return_inverse=True)
                top = np.zeros(len(a), np.int64)
                np.maximum.at(top, at, counts)
                yield pd.DataFrame({"a": a, "n": top})

    found = tables.select("keys", "counts").mapInPandas(run, "a long, n long").groupBy("a").agg(F.max("n").alias("n"))
    return {r["a"]: r["n"] for r in found.collect()}


def counted(docs: DataFrame, paths: tuple[str, str], chunk: int, portion: int, per_shard: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """First pass's rows, requests of all chunks, count tables of all shards, and the number of salts."""
    stage = written(first_pass(docs, paths, chunk, portion))
    pairs = stage.filter("kind = 0").select("chunk", "keys", "n")
    total = (pairs.agg(F.sum(F.length("keys"))).first()[0] or 0) // 8
    t = tokenizers(*paths)
    shards = max(1, -(-min(total, len(t.a_bytes) * len(t.b_bytes)) // per_shard))
    salts = max(1, -(-total // (shards * FAN_IN * per_shard)))
    requests = written(dealt(pairs, shards, salts))
    return stage, requests, count_tables(requests, shards, salts), salts


def pair_counts(docs: DataFrame, a_path: str, b_path: str, chunk: int = 8_000_000, portion: int = 500_000, per_shard: int = 1 << 18) -> DataFrame:
    """a, b, n_docs: every linked pair of ids and the number of documents that hold it. Cases as in ``align``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for keys, counts in zip(map(longs, b["keys"]), map(longs, b["counts"]), strict=True):
                yield pd.DataFrame({"a": keys >> 32, "b": keys & 0xFFFFFFFF, "n_docs": counts})

    return counted(docs, (a_path, b_path), chunk, portion, per_shard)[2].select("keys", "counts").mapInPandas(run, "a long, b long, n_docs long")


def align(docs: DataFrame, a_path: str, b_path: str, chunk: int = 8_000_000, portion: int = 500_000, per_shard: int = 1 << 18) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups: a row for every row of docs (doc_id, text).

    A is the byte-level vocabulary of ``a_path``, B the piece model of ``b_path``; both encode a blank and the
    text, in which special strings are plain text. ``groups`` are the tokens between offsets where both end, as
    ``a1,a2|b1;a3|b2,b3``. A pair's count is the number of rows of docs that link it; ``n_best`` are the links
    whose count is the highest of their A id, ``count_sum`` the counts of all links. Null and empty texts, and
    those that the tokens of one side do not give back, have zeros and empty groups. Repeated rows count each,
    ids may be null, an empty table gives no rows, and other columns do not matter. ``chunk`` and ``portion``
    (characters) and ``per_shard`` (pairs) bound what tasks hold; no result depends on them.
    """
    paths = (a_path, b_path)
    stage, requests, tables, salts = counted(docs, paths, chunk, portion, per_shard)
    best = np.zeros(len(tokenizers(*paths).a_bytes), np.int64)
    for a, n in best_counts(tables).items():
        best[a] = n
    corpus = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(best)  # one number for each id of the vocabulary

    def run(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        known, asked = segments(*paths).of_corpus(corpus), g[g["kind"] == 0]
        keys, counts = summed(list(map(longs, asked["keys"])), list(map(longs, asked["n"])))
        g = g[g["kind"] == 1]
        texts = string_list(g["text"])
        for lo, hi in portions(texts, portion):
            x = known.read(texts[lo:hi])
            known.weigh(x, keys, counts, shared.value)
            each = {"n_a": known.n_a, "n_b": known.n_b, "n_groups": known.n_groups, "n_links": np.diff(known.until), "n_best": known.weights[0], "count_sum": known.weights[1]}
            groups = [";".join(map(known.groups.__getitem__, c)) for c in x.cut]
            yield pd.DataFrame({"doc_id": exact_longs(g.iloc[lo:hi]).array, **{k: sums(v[x.flat], x.n) for k, v in each.items()}, "groups": groups})

    answers = replies(tables, requests, salts).withColumns({"kind": F.lit(0), "doc_id": F.lit(0).cast("long"), "no_doc_id": F.lit(True)})
    rows = stage.filter("kind = 1").drop("keys", "n").unionByName(answers, allowMissingColumns=True)
    return grouped(rows, ["chunk"], run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
