"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keyloom.llm import bpe, chat, components, jaccard, language, packing, pretokens, quality, queries, token_counts, topk, toxicity, url_filter

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, n string"
ODD = [
    None, "", " ", "a", "The the  THE\n\n the's we'll I'd", "x<|endoftext|>y <|endoftext|>", "²½Ⅷ٣ a1\x1cb\x1f c\x85d e", "日本語のテキスト 漢字", "é ño",
    "🙂🙂 ‍👩", "  lead\ttab \r\n", "a" * 3000, "ab " * 2000, "don't 'S 've'll", "<|endoftext|>", "naïve café über straße", "   \n \n  x",
]


def frame(spark, texts):
    rows = [(i, t, "en", "s", 0, "clash", "clash") for i, t in enumerate(texts)] + [(0, texts[0], "en", "s", 0, None, None)]
    return spark.createDataFrame(rows, DOCS)


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


# ---- tokens


def test_split_patterns_agree():
    import regex

    want = regex.compile(pretokens.PATTERN)
    random.seed(3)
    chars = "aÀz1²٣Ⅷ _'\n\t\x1c\x85 　.,sx🙂́漢"
    for t in [x for x in ODD if x] + ["".join(random.choices(chars, k=60)) for _ in range(300)]:
        assert pretokens.pretokens(t) == want.findall(t), t
        assert pretokens.exact_splitter().findall(t) == want.findall(t), t


def test_token_counts(spark):
    for head in (0, 5, 1000):
        got = token_counts.token_counts(frame(spark, ODD), PATH, head=head).collect()
        assert len(got) == len(ODD) + 1
        for r in got:
            assert (r.n_bytes, r.n_tokens) == (len((ODD[r.doc_id] or "").encode()), len(ids_of(ODD[r.doc_id]))), ODD[r.doc_id]
    assert token_counts.token_counts(frame(spark, ODD).limit(0), PATH).count() == 0


def test_bpe_round_trip(spark):
    for r in bpe.round_trip_digests(frame(spark, ODD), PATH).collect():
        text = ODD[r.doc_id] or ""
        assert r.ids_sha256 == hashlib.sha256(packed(ids_of(text))).hexdigest(), text
        assert r.decoded_sha256 == hashlib.sha256(Tokenizer.from_file(PATH).decode(ids_of(text), skip_special_tokens=False).encode()).hexdigest(), text
    back = bpe.decode(bpe.encode(frame(spark, ODD), PATH), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(ODD)}


def test_trie_forgets_and_stays_right():
    words = bpe.PrefixTrie(bpe.Vocabulary(PATH), most=50)
    for group in (["the", "there", " there", "theres"], ["zzzzqq", " antidis", "antidisestablish"], ["the", "thorough"]):
        if words.full():
            words.forget()
        words.insert(group)
        for w in group:
            assert list(np.frombuffer(words[w], "<u4")) == ids_of(w)


def test_seams_equal_simulated_merges():
    v = bpe.Vocabulary(PATH)
    random.seed(1)
    ids = list(v.id_of.values())
    for a, b in (random.choices(ids, k=2) for _ in range(3000)):
        assert v.seam_holds(a, b) == (v.merge(v.bytes_of[a] + v.bytes_of[b]) == [a, b])


# ---- packing


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + "\n" * 1_000_000 + "b", "x" + " \t\r\n\u3000" * 100_000 + "<|endoftext|>" + "\x85" * 150_000 + "<|endoftext|>" + " " * 300_000 + "y z", "ab" * 300_000])
def test_very_long_runs(text):
    want = packed(ids_of(text))
    assert packing.encoder(PATH)(text) == want
    assert b"".join(bpe.encode_texts([text], PATH)) == want


def test_five_million_blanks(spark):
    text = " " * 5_000_000 + "x"
    got = packing.pack_documents(frame(spark, [text]).limit(1), PATH).agg(F.sum("length"), F.max("piece")).first()
    assert got[0] == len(ids_of(text)) + 1 and got[1] == -(-got[0] // 2048) - 1


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            g = min(fits)
            gaps.remove(g)
            gaps.append(g - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_best_fit_decreasing(seed):
    random.seed(seed)
    lengths = [random.choice([1, 2, 3, 7, 20, random.randint(1, 100)]) for _ in range(random.choice([1, 50, 700]))]
    plan, opened = packing.best_fit_plan(Counter(lengths), 100)
    assert opened == best_fit_decreasing(lengths, 100)
    assert packing.best_fit_plan({}, 100)[1] == 0


def test_packing(spark):
    texts = ODD + ["word " * n for n in (1, 5, 9, 70, 70, 70, 400)]
    got = packing.pack_documents(frame(spark, texts), PATH, capacity=64).collect()
    at, per_doc = defaultdict(list), defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
        per_doc[r.doc_id].append(r)
    for spans in at.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= 64
    for d, t in enumerate(texts):
        ids = [*ids_of(t), 0]
        for r in per_doc[d]:
            assert zlib.crc32(packed(ids[r.start : r.start + r.length])) == r.ids_crc32
        starts = sorted({(r.piece, r.start, r.length) for r in per_doc[d]})
        assert sum(n for _, _, n in starts) == len(ids) and all(n == 64 for p, _, n in starts if p) and len(starts) == -(-len(ids) // 64)
    assert packing.pack_documents(frame(spark, texts).limit(0), PATH).count() == 0


# ---- near duplicates


def sets_of(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(texts, k, percent):
    sets = {i: sets_of(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}
    links = Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), links[i]) for i in texts}


@pytest.mark.parametrize("longest, block, least", [(48, 512, 8), (2, 7, 2)])
def test_jaccard_components(spark, longest, block, least):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = random.choices(vocabulary, k=25)
    texts = [None, "", " \n", "one two", "One TWO", "one two three", "x", "x"]
    for n in (8, 30, 120):
        base = random.choices(vocabulary, k=n)
        for _ in range(14):
            w = base[:]
            for _ in range(random.randint(0, max(1, n // 25))):
                w[random.randrange(len(w))] = random.choice(vocabulary)
            texts.append(" ".join(w))
    texts += [" ".join(random.choices(vocabulary, k=20) + passage) for _ in range(15)] + [" ".join(passage)] * 5
    found = jaccard.jaccard_components(frame(spark, texts).filter("node is not null"), k=4, percent=80, longest=longest, block=block, least=least)
    want = brute_components(dict(enumerate(texts)), 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in found.collect()} == want
    assert jaccard.jaccard_components(frame(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("leaders", [0, 1, 32])
def test_components_without_counts(spark, leaders):
    random.seed(6)
    texts = []
    for n in (30, 60):  # two families and texts between that share long lists with them
        base = [f"b{n}_{i}" for i in range(n)]
        for _ in range(60):
            w = base[:]
            for _ in range(random.choice([0, 1, 1, 2, 5])):
                w[random.randrange(n)] = f"x{random.randrange(30)}"
            texts.append(" ".join(w))
    want = brute_components(dict(enumerate(texts)), 4, 70)
    found = jaccard.jaccard_components(frame(spark, texts).filter("node is not null"), k=4, percent=70, count_links=False, longest=4, block=9, least=2, leaders=leaders, small=0)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == {d: w[:2] for d, w in want.items()}
    assert {r.n_links for r in found.collect()} == {None}


def test_a_family_costs_rows_in_proportion(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(jaccard, "search_groups", lambda met, *a, f=jaccard.search_groups: sent.append(met.count()) or f(met, *a))
    for n in (1000, 4000):
        base, passage = [f"b{i}" for i in range(100)], [f"p{i}" for i in range(60)]
        texts = [" ".join([*base[: i % 100], f"x{i}", *base[i % 100 + 1 :]]) for i in range(n)] + [" ".join([*(f"o{i}_{j}" for j in range(50)), *passage]) for i in range(n // 10)]
        found = jaccard.jaccard_components(frame(spark, texts).filter("node is not null"), count_links=False, block=100)
        assert {r.component_id for r in found.collect()} == {0, *range(n, n + n // 10)}
    assert sent[1] <= 4.5 * sent[0] + 200


def test_components(spark):
    assert components.connected_components(spark.createDataFrame([(1, 2), (None, 3), (5, 2)], "a long, b long"), native=True).count() == 3
    names = spark.createDataFrame([("x", "y"), ("z", "y"), ("p", "p")], "a string, b string")
    assert sorted(map(tuple, components.connected_components(names, native=True).collect())) == [("x", "x"), ("y", "x"), ("z", "x")]
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 201), (200, 202), (200, 203)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100} | {i: 200 for i in range(200, 204)}


def test_components_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(components, "PER_TASK", 7)
    random.seed(2)
    edges = [(i, i + 1) for i in range(60)] + [(100 + random.randrange(40), 100 + random.randrange(40)) for _ in range(25)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got.collect()} == {x: root[x] for x in linked}


# ---- url filter


def test_url_filter(spark):
    pages = [
        (1, "http://A.example.org/x/1", '<link rel="canonical" href="https://evil.com/de/9">'), (2, "https://evil.com/de/9", "<p>"),
        (3, "http://b.net/q", '<meta http-equiv="refresh" content="0; url=/r">'), (4, "http://b.net/r#f", None), (5, None, None), (6, "nohost", ""),
        (7, "http://s.net/a", "<link href='http://bad.com/de/1' rel='x'><link rel='canonical' href='http://bad.com/de/1'>"), (7, "http://s.net/a", None),
        (8, "http://bad.com/de/1?q", ""), (9, "http://example.org/en/12", ""), (10, "http://com/fr/", ""), (11, "http://org", ""), (12, "http://t.net/u/v", "<link rel=canonical href='w'>"), (13, "http://t.net/u/w", ""),
    ]
    p = spark.createDataFrame([(*x, "extra") for x in pages], "page_id long, url string, html string, node string")
    rules = spark.createDataFrame(queries.URL_RULES, "verdict string, host string, path string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(p, rules).collect()}
    assert got[1] == ("a.example.org", "/x/1", "org/", "allow") and got[2] == ("evil.com", "/de/9", "com/de/", "block")
    assert got[3] == ("b.net", "/q", None, "allow") and got[5] == ("", "", None, "allow") == got[6]
    assert got[7] == ("s.net", "/a", None, "block") and got[8][3] == "block"  # an alias of a blocked page
    assert got[9][2:] == ("example.org/en/1", "block") and got[10][2] == "com/fr/" and got[11] == ("org", "", None, "allow")
    r = {x.page_id: x.component for x in url_filter.judge_urls(p, rules).collect()}
    assert r[12] == r[13] == "t.net/u/v" and r[3] == r[4]
    more = spark.createDataFrame([("http://b.net/q", "http://evil.com/de/9")], "a string, b string")
    assert {x.page_id: x.verdict for x in url_filter.judge_urls(p, rules, more).collect()}[4] == "allow"  # explicit allow of page 1
    assert url_filter.judge_urls(p.limit(0), rules).count() == 0


def test_all_links_of_a_page(spark):
    html = "<link rel=canonical href='/2'><LINK href='//v.net/3' rel='canonical'><meta http-equiv=refresh content='0; url=4'><meta http-equiv=refresh content='9'><link rel=x href=5>"
    pages = spark.createDataFrame([("http://u.net/1", html), ("http://u.net/6", None), (None, html)], "url string, html string")
    got = url_filter.page_edges(pages).collect()
    assert {r.a for r in got} == {"u.net/1"} and sorted(r.b for r in got) == ["u.net/2", "u.net/4", "v.net/3"]  # nodes have no scheme



# ---- quality


def test_quality(spark):
    random.seed(2)
    texts = [*ODD, "a b c d e a b c d e", "x " * 40, "l\nl\n\nl\n- x\n* y", "end...\nthe of…", "# $ % & | < >"] + [" ".join(random.choices("a b c the of".split(), k=n)) for n in (4, 5, 6, 30, 60)]
    for r in quality.rule_report(frame(spark, texts)).collect():
        t = texts[r.doc_id] or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        five = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if five[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)), t
        assert r.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w)) and not (r.kept and r.base_failed)


# ---- toxicity


def test_toxicity(spark):
    random.seed(4)
    clean = ["".join(random.choices("abcdefgh ", k=random.randint(20, 200))) for _ in range(240)]
    texts = [t + " IDIOTS!" if i % 4 == 0 else t for i, t in enumerate(clean)] + [None, ""]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(240)] + [(None, 1, 1), (3, None, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = {r.doc_id for r in labels.filter(toxicity.held_out()).collect()} - {None}
    assert held == {i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(240)) and 0 <= got[241] < 0.5
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in range(242) if i % 4 or i >= 240}
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}


# ---- language


def test_language(spark):
    say = {"en": "the house and the garden of this old town are with trees", "de": "das haus und der garten dieser alten stadt sind mit bäumen", "fr": "la maison et le jardin de cette vieille ville avec des arbres"}
    rows = [(i, say[x] + f" {i}", x if i % 7 else None, f"h{i % 3}.{x}", 0, "c", "c") for i, x in enumerate(["en", "de", "fr"] * 30)]
    rows += [(100, None, "en", None, 0, "c", "c"), (101, "123 456", "de", "h.de", 0, "c", "c"), (102, say["de"], "en", "h0.de", 0, "c", "c"), (None, say["fr"], "xx", "h1.fr", 0, "c", "c"), (103, say["en"] * 500, None, None, 0, "c", "c")]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i].language == ["en", "de", "fr"][i % 3] and got[i].kept for i in range(90))
    assert got[100].language == got[101].language == "und" and not got[100].kept and not got[101].kept
    assert got[102].language == "de" and got[None].language == "fr" and got[103].language == "en"
    assert language.identify(spark.createDataFrame(rows, DOCS).limit(0)).count() == 0


# ---- top-k


def test_top_k(spark):
    random.seed(6)
    rows = [(i, [random.choice([-1.0, -0.5, 0.01, 0.25, 3.0]) for _ in range(6)], "e") for i in range(150)]
    rows += [(200 + i, [1.0] * 6, "e") for i in range(12)] + [(300, None, "e"), (301, [1.0, None], "e"), (302, [float("nan")] * 6, "e"), (303, [float("inf")] * 6, "e"), (None, [9.0] * 6, "e"), (304, [2.0], "e"), (200, [1.0] * 6, "e"), (305, [], "e")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for at, (q, x) in enumerate(good):
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for n, (i, y) in enumerate(good) if n != at)[:5]
            want.update((q, n + 1, i, -score) for n, (score, i) in enumerate(best))
    asked = F.col("vec_id") % 10 == 0
    for how in ({"per_block": 20, "together": 3}, {"per_block": 7, "probes": 1}, {}):
        got = topk.top_k(df.repartition(3), asked, k=5, **how)
        assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want
    big = spark.createDataFrame([(0, [1e6, 1.0], "e"), (1, [1e6, -1e6], "e"), (2, [1e6, 1e6], "e")], df.schema)  # sums beyond exact doubles
    top = topk.top_k(big, F.col("vec_id") == 0, k=1).first()
    assert (top.vec_id, top.score) == (2, 256_000_000**2 + 256 * 256_000_000)
    twice = topk.top_k(spark.createDataFrame([(0, [1.0], "e"), (7, [2.0], "e"), (7, [3.0], "e")], df.schema), F.col("vec_id") == 0, k=5)
    assert [(r["rank"], r.vec_id, r.score) for r in twice.orderBy("rank").collect()] == [(1, 7, 768 * 256), (2, 7, 512 * 256)]
    assert topk.top_k(df.limit(0), asked).count() == 0 and topk.top_k(df, F.col("vec_id") < 0).count() == 0


@pytest.mark.parametrize("skew", [True, False])
def test_postings_are_skipped_on_proof(skew):
    rng = np.random.default_rng(4)
    data = rng.integers(-300, 300, (3000, 32))
    if skew:
        data = (data * rng.pareto(1.2, data.shape)).astype(np.int64)
    block = topk.Block(np.arange(3000), data, *topk.segments(data))
    for i in range(0, 3000, 100):
        want = sorted((-x, at) for at, x in enumerate((data @ data[i]).tolist()) if at != i)[:5]
        assert [(-s, at) for s, at in block.best(data[i : i + 1], 5, np.array([-np.inf]), np.array([i]))[0]] == want
    assert block.read < (0.6 if skew else 1.0) * data.size * 30
    before = block.read
    assert block.best(data[:9], 5, np.full(9, 1e18), np.full(9, -1)) == [[]] * 9 and block.read == before  # a bound that no vector reaches


# ---- chat


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, starts string"
    rows = [(c, t, ("user", "assistant")[t % 2], f"Question number {t}?" if t % 2 == 0 else f"It is so.\nand more {t}", "e") for c in range(20) for t in range(c + 1)]
    rows += [(50, 0, "system", "Be kind.", "e"), (50, 1, "user", "Hi?", "e"), (None, None, None, None, "e"), (51, 0, "user", None, "e")]
    turns = spark.createDataFrame(rows, schema)
    marked = chat.transcript(turns, every=10**9)
    model = chat.fit(marked)
    got = {(r.conv_id, r.turn): r for r in chat.parse(marked, model).collect()}
    assert len(got) == len(rows) and all(got[c, t].role == role and got[c, t].starts for c, t, role, text, _ in rows if text)
    assert got[3, 1].rendered == "<|assistant|>\nIt is so.\nand more 1"
    bare = chat.transcript(turns, every=2)
    whole = sorted(map(str, chat.parse(bare, model, rows=1000).collect()))
    assert whole == sorted(map(str, chat.parse(bare, model, rows=2, fan_in=2).collect()))  # blocks change nothing
    lines = [line for c, t, *_ in sorted(rows[:210]) if c == 19 for line in [r.text for r in bare.filter(f"conv_id = 19 and turn = {t}").collect()][0].split("\n")]
    steps = chat.line_matrices(model, lines)
    score = np.r_[np.full(chat.S, -np.inf), 0.0]
    back = []
    for m in steps:
        back.append((score[:, None] + m).argmax(axis=0))
        score = (score[:, None] + m).max(axis=0)
    at, path = int(score.argmax()), []
    for b in reversed(back):
        path.append(at)
        at = int(b[at])
    assert [s for _, s in chat.best_path(np.r_[np.full(chat.S, -np.inf), 0.0], steps, None)] == path[::-1]
    assert chat.parse(turns.limit(0), model).count() == 0


def test_rows_without_a_conversation_are_apart(spark):
    turns = [(1, t, ("user", "assistant")[t % 2], ("Hi?", "Yes.")[t % 2]) for t in range(40)]
    schema = "conv_id long, turn long, role string, text string"
    model = chat.fit(spark.createDataFrame(turns, schema))
    alone = spark.createDataFrame([(None, t, None, "Yes.") for t in range(40)] + [(None, None, None, None)] * 3, schema)
    got = chat.parse(alone, model).collect()
    assert len(got) == 43 and len({(r.role, r.starts) for r in got if r.turn is not None}) == 1  # as each would be judged by itself
    assert all(r.conv_id is None and r.starts for r in got)


# ---- pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    random.seed(8)
    words = "the house and garden of this old town are with trees nice idea from people who like long walks at night".split()
    text = lambda n: " ".join(random.choices(words, k=n))
    same = text(60)
    texts = [text(50) for _ in range(60)] + [same, same, same + " more", None, "", "12 34"] + [text(30) + " idiots" for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int("idiots" in (t or ""))) for i, t in enumerate(texts)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = [set(range(63)) | set(range(66, 96)), set(range(63)), set(range(61))]
    for (_, stage), ids in zip(corpus_pipeline.STAGES[:-1], left, strict=True):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r.doc_id for r in docs.collect()} == ids
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == left[-1] and sum(r.length for r in got) == sum(len(ids_of(texts[i])) + 1 for i in left[-1])
    assert docs.filter(F.col("doc_id").isNull()).count() == 0
