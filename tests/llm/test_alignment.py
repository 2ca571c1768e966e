"""op11 against a plain pairwise alignment with the tokenizers' own libraries; the perfect hash on its own."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from keyloom.llm import alignment
from keyloom.llm.perfect_hash import CountTable, PerfectHash

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def byte_of() -> dict[str, int]:
    """The published table of byte-level vocabularies, the other way round."""
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    out = {chr(b): b for b in shown}
    for n, b in enumerate(x for x in range(256) if x not in shown):
        out[chr(256 + n)] = b
    return out


class Plain:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.table = byte_of()

    def spans(self, text):
        """(id, bytes) of both sides."""
        a = [(i, bytes(self.table[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        return a, b

    def align(self, text):
        if not text:
            return None
        a, b = self.spans(text)
        data = (" " + text).encode()
        if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            return None
        ends = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            ends.append(out)
        links = [(i, j) for i, lo, hi in ends[0] for j, lo2, hi2 in ends[1] if max(lo, lo2) < min(hi, hi2)]
        cuts = sorted({hi for _, _, hi in ends[0]} & {hi for _, _, hi in ends[1]})
        lo, groups = 0, []
        for c in cuts:
            groups.append("|".join(",".join(str(i) for i, x, y in side if lo <= x and y <= c) for side in ends))
            lo = c
        return len(a), len(b), groups, links


def brute(rows):
    plain = Plain()
    found = [(doc_id, plain.align(text)) for doc_id, text in rows]
    count = Counter(p for _, x in found if x for p in set(x[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, x in found:
        if x is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = x
            out.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), ";".join(groups)))
    return out, count


def key(row):
    return tuple((x is not None, x) for x in row)


ODD = [
    (1, "The quick brown fox  jumps over the lazy dog."), (2, None), (3, ""), (4, " "), (5, "a\n\n b\t c \n"), (6, "naïve café — “quoted” 中文字 👩‍👩‍👧"),
    (7, "has ▁ a low line"), (8, "<|endoftext|> and <s> </s> <0x41>"), (9, "x\0y\x1c z  end "), (10, "don't we'll 12345  67"), (None, "no id here"),
    (1, "The quick brown fox  jumps over the lazy dog."), (2**60 + 1, "wide id"), (11, "́combining é ﬁ Ａ"), (12, "   "),
]


@pytest.mark.parametrize("how", [{}, {"chunk": 60, "portion": 30, "per_shard": 7}])
def test_alignment_equals_plain_one(spark, how):
    chance = random.Random(5)
    texts = [(100 + i, "".join(chance.choice(["the ", "of", " ", "\n", "ß", "Ω", "12", "'s", "--", "tion", "中", "  ", "x"]) for _ in range(chance.randint(1, 60)))) for i in range(60)]
    rows = ODD + texts
    docs = spark.createDataFrame([(d, t, "en", 3) for d, t in rows], "doc_id long, text string, n_a string, chunk int").repartition(3)
    expected, count = brute(rows)
    got = [tuple(r) for r in alignment.align(docs, A, B, **how).select(COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    pairs = {(r["a"], r["b"]): r["n_docs"] for r in alignment.pair_counts(docs, A, B, **how).collect()}
    assert pairs == dict(count)


def test_corpora_one_after_another(spark):
    """Python workers outlive a query: what they keep of segments must not speak of another corpus."""
    for n in (3, 1, 7):
        docs = [(i, "the same words") for i in range(n)]
        got = alignment.align(spark.createDataFrame(docs, "doc_id long, text string"), A, B).select(COLUMNS).collect()
        assert sorted(map(tuple, got)) == sorted(brute(docs)[0])


def test_nothing_to_align(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A, B).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.align(docs, A, B).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_segments_of_long_texts():
    t, plain = alignment.tokenizers(A, B), Plain()
    words = "one two  three\n four five's 66 blah x".split(" ")
    texts = [" ".join(words * 6000), "a" * 150_000, " " * 200_000 + "x", "ab " * 60_000, "中文" * 40_000, "x \n y\n z", "q ", "a b c d"]
    for most in (150_000, 3):
        known = alignment.Segments(t, most)
        for text in texts * 2:
            x = known.read([text, "", "low ▁ line", text])
            a, b = plain.spans(text)
            assert list(x.n > 0) == [True, False, False, True]
            assert list(alignment.sums(known.n_a[x.flat], x.n)) == [len(a), 0, 0, len(a)]
            groups = ";".join(map(known.groups.__getitem__, x.cut[3])).split(";")
            for side, ids in enumerate((a, b)):
                assert [int(i) for g in groups for i in g.split("|")[side].split(",")] == [i for i, _ in ids]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 100_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
    h = PerfectHash.build(keys)
    slots = h.slots(keys)
    assert sorted(slots) == list(range(len(keys)))
    table = CountTable(h.sizes, h.packed, keys[np.argsort(slots)], np.arange(len(keys))[np.argsort(slots)])
    assert (table.get(keys) == np.arange(len(keys))).all()
    assert (table.get(np.setdiff1d(np.arange(500), keys)) == 0).all()
