"""Rare languages, words of any length, and the alias SQL on pages that hold links."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
from keyloom.llm import jaccard, language, queries, token_counts, toxicity, url_filter
from tokenizers import Tokenizer

ENGLISH = "the quick brown fox jumps over the lazy dog and then it sleeps under a tree while rain falls on the old house by the river".split()
GERMAN = "der schnelle braune fuchs springt über den faulen hund und schläft dann unter einem baum während regen auf das alte haus am fluss fällt".split()


def texts(words, n, seed):
    chance = random.Random(seed)
    return [" ".join(chance.choice(words) for _ in range(60)) for _ in range(n)]


def test_rare_languages_stay(spark):
    rows = [(i, t, "en", "a.com") for i, t in enumerate(texts(ENGLISH, 400, 1))] + [(1000 + i, t, "de", "b.de") for i, t in enumerate(texts(GERMAN, 3, 2))]
    junk = ["".join(random.Random(i).choices("bcdfghjklmnpqrstvwxz     ", k=300)) for i in range(4)]
    rows += [(2000 + i, t, said, "a.com") for i, (t, said) in enumerate(zip(junk, ("en", None, "und", "not a code"), strict=True))] + [(3000, "12345 !!", "de", "b.de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in language.keep_identified(docs).collect()}
    assert {1000, 1001, 1002} <= kept and len(kept & set(range(400))) >= 396 and not kept & {2000, 2001, 2002, 2003, 3000}
    assert {r["language"] for r in language.identify(docs).filter("doc_id between 1000 and 1002").collect()} == {"de"}


def test_many_languages_none_of_which_is_frequent(spark):
    names = [a + b for a in "abcdefghijklm" for b in "nopqrstuvwxy"]
    rows = [(i, t, names[i % len(names)], "h") for i, t in enumerate(texts(ENGLISH, 312, 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert language.judged(docs).count() == 312 and language.identify(docs).filter("kept").count() >= 150


def test_n_grams_of_long_texts_in_parts(monkeypatch):
    chance = random.Random(1)
    monkeypatch.setattr(toxicity, "AT_ONCE", 3000)
    words = {"".join(chance.choices("abcdé中", k=n)) for n in (1, 2, 5, 999, 1000, 1001, 4000)}
    parts = list(toxicity.distinct_grams(words, (3, 5)))
    want = {g for w in words for g in toxicity.grams_of(w, (3, 5))}
    assert len(parts) > 3 and Counter(g for p in parts for g in p) == Counter(want) and max(map(len, parts)) < 2 * 3000
    kept = {g: i for i, g in enumerate(sorted(want)[::7])}
    of_word = toxicity.WordFeatures(kept, (3, 5))
    for w in words:
        assert sorted(of_word[w]) == sorted(kept[g] for g in toxicity.grams_of(w, (3, 5)) if g in kept)


def test_a_word_of_millions_of_letters_in_little_memory():
    word = "".join(map(chr, np.random.default_rng(1).integers(97, 123, 3_000_000)))
    tracemalloc.start()
    assert len(toxicity.text_features(word, toxicity.WordFeatures({"abc": 0, "zzzzz": 1}, (3, 5)))) >= 1
    assert sum(len(p) for p in zip(range(3), toxicity.distinct_grams({word}, (3, 5)), strict=False)) > 0
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_counts_of_n_grams_and_optimum_of_the_fit(spark):
    sample = [("a bad word", 1), ("bad bad", 1), ("good word", 0), ("", 0)]
    df = spark.createDataFrame(sample, "text string, label int")
    got = {r["gram"]: (r["pos"], r["neg"]) for r in toxicity.gram_counts(df, (3, 5), held=4).collect()}
    want = Counter((g, y) for t, y in sample for g in {g for w in t.split() for n in (3, 4, 5) for s in [f"\x02{w}\x03"] for g in (s[i : i + n] for i in range(len(s) - n + 1))})
    assert got == {g: (want[g, 1], want[g, 0]) for g, _ in want}
    chance = np.random.default_rng(3)
    rows, y, scale = [np.sort(chance.choice(20, 5, replace=False)) for _ in range(200)], chance.integers(0, 2, 200).astype(float), chance.normal(size=20)
    w, bias = toxicity.logistic(rows, y, scale, 10.0, rounds=500)
    x = np.zeros((200, 20))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
    d = 1 / (1 + np.exp(-(x @ w + bias))) - y
    assert np.abs(x.T @ d + 10.0 * w).max() < 0.3 and abs(d.sum()) < 0.3  # the gradient of the loss is near nothing


def test_alias_sql_on_pages_with_links(spark):
    import duckdb

    link = lambda *to: "".join(f'<link rel="canonical" href="{t}">' for t in to)
    refresh = lambda to: f'<meta http-equiv="refresh" content="0; url={to}">'
    pages = [
        (1, "http://a.net/x", link("http://b.net/1", "http://example.org/es/q")), (2, "http://c.net/y", link("//d.net/z") + refresh("/w?a=1&amp;b=2")), (3, "http://c.net/w?a=1&b=2", ""),
        (4, "http://e.com/de/1", link("http://f.net/")), (5, "http://f.net/", link("g")), (6, "http://f.net/g", None), (7, "http://h.com/fr/", link("http://a.net/x")), (8, None, link("http://a.net/x")), (9, "no url", ""),
        (10, "HTTP://B.NET/1", "<p>none</p>"), (11, "http://z.net/", refresh("http://z.net/#same")),
    ]
    rules = spark.createDataFrame(queries.URL_RULES, "verdict string, host string, path string")
    got = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), rules)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    cur = con.execute(queries.ORACLE_SQL["op1_url_filter"])
    names = [c[0] for c in cur.description]
    plain = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    assert plain(got.select(names).collect()) == plain(cur.fetchall())
    assert {r["page_id"]: r["verdict"] for r in got.collect()}[4] == "block"


def test_repeated_values_are_counted_in_place():
    rng = np.random.default_rng(5)
    for size, kinds in ((0, 1), (1, 1), (2, 1), (7, 3), (500, 90), (500, 10**9)):
        a = rng.integers(0, kinds, size).astype(np.uint64)
        u, n = np.unique(a, return_counts=True)
        values, counts = jaccard.repeated(a)
        assert values.tolist() == u[n > 1].tolist() and counts.tolist() == n[n > 1].tolist()


def test_frequent_long_pretokens_are_looked_up(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    divider, once = "-" * 40, "=" * 50
    rows = [(i, f"part {i}\n{divider}\nmore") for i in range(60)] + [(100, f"{once} x"), (101, None), (102, "é" * 33), (103, "é" * 33)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = token_counts.pretoken_table(docs, path)
    lookup = token_counts.most_frequent(table, head=8, longest=32)
    digest = hashlib.sha256(divider.encode()).digest()
    assert len(lookup) == 8 and digest in lookup and divider not in lookup
    assert all(len(k) <= 32 for k in lookup)
    tokenizer = Tokenizer.from_file(path)
    expected = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    for head in (1, 8, 131_072):
        assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, path, head=head).collect()} == expected
