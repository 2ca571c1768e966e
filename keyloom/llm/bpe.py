"""Encoding and decoding with a byte-level vocabulary by depth-first states of a word trie.

For merges by rank, every prefix of a word has one last token: the suffix t of the prefix such that t
follows the last token of what stands before it without any merge across the seam. Each node of the
trie is a prefix and stores that last token and the node where it begins, so the encoding of a shared
prefix is computed once, and a word's ids are read off by walking back token by token.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from keyloom.llm.common import exact, exact_longs, string_list
from keyloom.llm.pretokens import pretokens, special_cutter, special_ids


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tails(dict):
    """The sizes that tokens ending in these (at most 3) bytes have, the longest first, shorter endings included."""

    def __init__(self, exact: dict[bytes, tuple[int, ...]]):
        self.exact = exact

    def __missing__(self, tail: bytes) -> tuple[int, ...]:
        sizes = {s for i in range(len(tail)) for s in self.exact.get(tail[i:], ())}
        self[tail] = sizes = tuple(sorted(sizes, reverse=True))
        return sizes


def raw_bytes(token: str, stand_in: dict[str, int]) -> bytes:
    return bytes(map(stand_in.__getitem__, token))


def token_bytes(tokenizer_path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """ids of the tokens by their bytes, and of the special strings, of a tokenizer file."""
    with open(tokenizer_path, encoding="utf-8") as f:
        data = json.load(f)
    stand_in, special = byte_alphabet(), {t["content"]: t["id"] for t in data["added_tokens"]}
    return {raw_bytes(s, stand_in): i for s, i in data["model"]["vocab"].items() if s not in special}, special


class Vocabulary:
    """Token bytes, ids and merges of a tokenizer file."""

    def __init__(self, tokenizer_path: str):
        self.id_of, self.specials = token_bytes(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        stand_in = byte_alphabet()
        self.bytes_of = [b""] * (1 + max([*self.id_of.values(), *self.specials.values()]))
        for b, i in self.id_of.items():
            self.bytes_of[i] = b
        for s, i in self.specials.items():
            self.bytes_of[i] = s.encode()
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.made_of: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(merges):
            a, b = (self.id_of[raw_bytes(x, stand_in)] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            self.rank[a, b] = r, whole
            self.made_of[whole] = a, b, r
        self.spines: tuple[dict, dict] = {}, {}
        self.alone: dict[int, bool] = {}
        sizes: dict[bytes, set[int]] = defaultdict(set)
        for b in self.id_of:
            sizes[b[-3:]].add(len(b))
        self.tails = Tails({k: tuple(sorted(v, reverse=True)) for k, v in sizes.items()})

    def merge(self, data: bytes) -> list[int]:
        """Merges by rank, leftmost first; used only on the bytes of two tokens."""
        ids, rank = [self.id_of[data[i : i + 1]] for i in range(len(data))], self.rank
        while len(ids) > 1:
            best = min(((rank[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in rank), default=None)
            if best is None:
                break
            (_, new), i = best
            ids[i : i + 2] = [new]
        return ids

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols at the token's left (0) or right (1) end while it is built, each with the rank that ends it."""
        known = self.spines[side].get(token)
        if known is None:
            known, end, at = [], float("inf"), token
            while True:
                known.append((at, end))
                if at not in self.made_of:
                    break
                end, at = self.made_of[at][2], self.made_of[at][side]
            known.reverse()
            self.spines[side][token] = known
        return known

    def seam_holds(self, before: int, token: int) -> bool:
        """The two tokens stay apart: no merge over the seam comes before those that build the tokens.

        Of equal ranks the leftmost merge comes first, so a merge over the seam wins against one on its
        right and loses against one on its left.
        """
        if token not in self.alone:
            self.alone[token] = self.merge(self.bytes_of[token]) == [token]
        if not self.alone[token]:
            return False
        if before < 0:
            return True
        left, right = self.spine(before, 1), self.spine(token, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            over = self.rank.get((x, y))
            if over is not None and over[0] < x_ends and over[0] <= y_ends:
                return False
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
            if i == len(left) or j == len(right):
                return True


class PrefixTrie(dict):
    """word -> ids as little-endian uint32 bytes, by states of a trie of bytes.

    Node 0 is the root; ``kids`` maps (node, byte) to a node, ``last`` is a node's last token and
    ``back`` the node where that token begins. The trie and the words' encodings are forgotten when
    there are more than ``most`` nodes, which bounds memory. Words of more than ``longest`` bytes have the same
    states, but in arrays of their own that are let go, as no other word is likely to share them.
    """

    longest = 4096

    def __init__(self, vocabulary: Vocabulary, most: int = 1_500_000):
        self.v, self.most = vocabulary, most
        self.seams: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.kids: dict[int, int] = {}
        self.last, self.back = array("i", [-1]), array("i", [0])
        self.long_bytes = 0

    def full(self) -> bool:
        return len(self.last) + self.long_bytes > self.most

    def holds(self, before: int, token: int) -> bool:
        """No merge crosses the seam between the two tokens (before -1: the token stands alone)."""
        if len(self.seams) > 1_000_000:
            self.seams.clear()
        known = self.seams[before << 20 | token] = self.v.seam_holds(before, token)
        return known

    def insert(self, words) -> None:
        """Insert words in sorted, that is depth-first order; states of shared prefixes are there already."""
        id_of, tails, kids, last, back, seams = self.v.id_of, self.v.tails, self.kids, self.last, self.back, self.seams
        for word in sorted(words):
            data, node, path = word.encode(), 0, [0]
            if len(data) > self.longest:
                self[word] = self.alone(data)
                self.long_bytes += len(data)
                continue
            for depth, byte in enumerate(data, 1):
                edge = node << 8 | byte
                node = kids.get(edge)
                if node is None:
                    for size in tails[data[depth - 3 : depth] if depth > 3 else data[:depth]]:  # longest first
                        if size <= depth and (token := id_of.get(data[depth - size : depth])) is not None:
                            start = path[depth - size]
                            known = seams.get(last[start] << 20 | token)
                            if known or known is None and self.holds(last[start], token):
                                break
                    node = kids[edge] = len(last)
                    last.append(token)
                    back.append(start)
                path.append(node)
            ids = []
            while node:
                ids.append(last[node])
                node = back[node]
            self[word] = array("I", ids[::-1]).tobytes()

    def alone(self, data: bytes) -> bytes:
        """ids of one long word; a prefix's state stands at its length."""
        id_of, tails, seams = self.v.id_of, self.v.tails, self.seams
        last, back = array("i", [-1]), array("i", [0])
        for depth in range(1, len(data) + 1):
            for size in tails[data[depth - 3 : depth] if depth > 3 else data[:depth]]:
                if size <= depth and (token := id_of.get(data[depth - size : depth])) is not None:
                    known = seams.get(last[depth - size] << 20 | token)
                    if known or known is None and self.holds(last[depth - size], token):
                        break
            last.append(token)
            back.append(depth - size)
        ids, at = array("I"), len(data)
        while at:
            ids.append(last[at])
            at = back[at]
        ids.reverse()
        return ids.tobytes()


_tries: dict[str, PrefixTrie] = {}


def trie(tokenizer_path: str) -> PrefixTrie:
    if tokenizer_path not in _tries:  # kept for the life of the Python worker
        _tries[tokenizer_path] = PrefixTrie(Vocabulary(tokenizer_path))
    return _tries[tokenizer_path]


def encode_texts(texts: list[str], tokenizer_path: str) -> Iterator[bytes]:
    """ids of each text as uint32 bytes; the distinct words of the texts go into the trie first."""
    words = trie(tokenizer_path)
    specials = special_ids(tokenizer_path)
    parts = special_cutter(specials)
    cut = [[(p, None) if special else (None, pretokens(p)) for p, special in parts(t)] for t in texts]
    if words.full():
        words.forget()
    words.insert({w for t in cut for _, ws in t if ws for w in ws}.difference(words))
    for t in cut:
        yield b"".join(np.uint32(specials[p]).tobytes() if p else b"".join(map(words.__getitem__, ws)) for p, ws in t)


def decode_ids(data: bytes, vocabulary: Vocabulary) -> str:
    """Text of ids given as uint32 bytes; byte sequences that are not UTF-8 become U+FFFD."""
    ids = np.frombuffer(data, dtype="<u4").tolist()
    return b"".join(map(vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def slices(texts: list[str], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of a batch of at most so many characters (or one text), which bounds what is cut at once."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (array of int): a row per document; null and empty texts have no ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = string_list(b["text"])
            for lo, hi in slices(texts):
                ids = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in encode_texts(texts[lo:hi], tokenizer_path)]
                yield pd.DataFrame({"doc_id": exact_longs(b.iloc[lo:hi]).array, "ids": ids})

    return docs.select(*exact(), "text").mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids give the empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = trie(tokenizer_path).v
        for b in batches:
            out = ["" if x is None else decode_ids(np.asarray(x, dtype="<u4").tobytes(), v) for x in b["ids"]]
            yield pd.DataFrame({"doc_id": exact_longs(b), "text": out})

    return encoded.select(*exact(), "ids").mapInPandas(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes every text and decodes its ids again.

    A row for every row of docs (doc_id, text; other columns do not matter), repeated ones too. Null and empty
    texts have no ids and the digests of nothing; ids may be null; an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = trie(tokenizer_path).v
        for b in batches:
            texts, rows = string_list(b["text"]), []
            for lo, hi in slices(texts):
                for data in encode_texts(texts[lo:hi], tokenizer_path):
                    decoded = decode_ids(data, v).encode()
                    rows.append((len(data) // 4, hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", exact_longs(b).array)
            yield out

    return docs.select(*exact(), "text").mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
