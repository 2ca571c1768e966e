"""Cases in which an operator must not do less than its whole job: unknown languages, wide ids, null ids, long groups."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from keyloom.llm import bpe, chat, jaccard, language, packing, token_counts, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, letters, n, words=60):
    """n texts in an invented language of 120 words over the letters."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(120)]
    return [" ".join(rng.choices(vocabulary, k=words)) for _ in range(n)]


@pytest.mark.parametrize("known", [1, 3])
def test_none_of_the_languages(spark, known):
    rng = random.Random(7)
    texts = [(t, f"l{i}") for i in range(known) for t in prose(i, "abcdefghijklmnopqrstuvwxyz", 60)]
    n = len(texts)
    texts += [("".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=300)), "l0") for _ in range(10)]  # gibberish
    texts += [("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(100)), "l0") for _ in range(10)]  # another script
    texts += [(t, None) for t in prose(99, "abcdefghijklmnopqrstuvwxyz", 10)]  # a language without a model
    texts += [(texts[0][0], "rare")]  # declared once, for a text in another language
    rows = [(i, t, x, f"h{i % 5}", 0) for i, (t, x) in enumerate(texts)]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i].kept and got[i].language == texts[i][1] for i in range(n))
    assert not any(got[i].kept or got[i].language != "und" for i in range(n, n + 30))


WIDE = (1 << 60) + 1  # no double


def test_wide_ids_beside_a_null_one(spark, tmp_path):
    import corpus_pipeline

    texts = prose(1, "abcdefghijklmnopqrstuvwxyz", 30)
    texts[2] = texts[1]
    ids = [None, *(WIDE + 2 * i for i in range(1, 30))]
    rows = [(d, t, "l0", "s", None if d is None else d + 1) for d, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)  # one batch
    labels = spark.createDataFrame([(d, 0) for d in ids[1:]], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    encoded = bpe.encode(docs, PATH)
    linked = jaccard.jaccard_components(docs)
    for name, out in {
        "op2": toxicity.score(docs, model), "op3": language.identify(docs), "op5": token_counts.token_counts(docs, PATH), "op6": packing.pack_documents(docs, PATH),
        "op7": linked, "op9": bpe.round_trip_digests(docs, PATH), "encode": encoded, "decode": bpe.decode(encoded, PATH),
    }.items():
        assert {r.doc_id for r in out.collect()} == set(ids), name
    assert {r.doc_id: r.component_id for r in linked.collect()} == {d: d for d in ids} | {ids[2]: ids[1]}
    kept = toxicity.keep_clean(docs, model)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(ids) - {ids[2]}


def test_links_through_rows_without_id_and_ids_with_two_texts(spark):
    words = [f"w{i}" for i in range(100)]
    swap = lambda at, by: " ".join(by if i in at else w for i, w in enumerate(words))
    a, between, b = swap((), ""), swap((30,), "x"), swap((30, 60), "x")  # 80 % of shingles: a - between - b only
    other, alone = " ".join(f"v{i}" for i in range(50)), " ".join(f"u{i}" for i in range(50))
    rows = [(5, a), (None, between), (7, b), (9, other), (9, alone), (None, alone), (3, alone), (None, "p q r s t u"), (None, "p q r s t u"), (8, ""), (None, None), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", i) for i, (d, t) in enumerate(rows)], DOCS)
    for block in (512, 2):
        got = jaccard.jaccard_components(docs, percent=90, block=block).collect()
        found = sorted(((r.doc_id, r.component_id, r.n_links) for r in got), key=str)
        want = [(5, 5, 1), (None, 5, 2), (7, 5, 1), (9, 9, 0), (9, 3, 2), (None, 3, 2), (3, 3, 2), (None, None, 1), (None, None, 1), (8, 8, 0), (None, None, 0), (None, None, 0)]
        assert found == sorted(want, key=str)
    left = sorted(((r.doc_id, r.text) for r in jaccard.drop_linked(docs, percent=90).collect()), key=str)
    assert left == sorted([(5, a), (9, other), (3, alone), (None, "p q r s t u"), (8, ""), (None, None), (None, None)], key=str)


def test_rows_of_one_id_are_identified_one_by_one(spark):
    texts = prose(0, "abcdefghijklmnopqrstuvwxyz", 40)
    rows = [(i % 39 or None, t, "l0", "s", 0) for i, t in enumerate(texts)] + [(1, "12 34", "l0", "s", 0), (None, "56", "l0", "s", 0), (2, texts[2], "l0", "s", 1)]
    left = language.keep_identified(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r.text for r in left) == sorted([*texts, texts[2]])


def test_evidence_of_pages(spark):
    words = {"en": "abcdefgh", "fr": "klmnopqr"}
    random.seed(8)
    rows = []
    for i in range(200):
        x = ("en", "fr")[i % 2]
        said = x if i % 10 < 8 else None
        body = " ".join("".join(random.choices(words[x], k=5)) for _ in range(40 if i < 190 else 1))
        rows.append((i, f"https://www.site{i % 2}.{'com' if i % 2 == 0 else 'fr'}/a", f"<!DOCTYPE html><HTML class=x{f' lang={chr(34)}{x}-XX{chr(34)}' if said else ''}><style>zz{{}}</style><script>if (a<b) zz</script><p>{body}&amp;</p>"))
    rows += [(900, None, None), (901, "no url", "<p>"), (None, "http://www.site0.com", "<html lang=en><p>abc abc</p>"), (None, "http://www.site0.com", "<html lang=en><p>abc abc</p>")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    seen = {r.doc_id: r for r in language.page_evidence(pages).collect()}
    assert seen[0].lang == "en" and seen[8].lang is None and seen[1].source == "www.site1.fr" and "zz" not in seen[0].text and seen[900].source is None
    got = language.identify(language.page_evidence(pages)).collect()
    assert len(got) == len(rows) and all(r.language == ("en", "fr")[r.doc_id % 2] for r in got if r.doc_id is not None and r.doc_id < 190)
    assert language.identify(language.page_evidence(pages.limit(0))).count() == 0


def fused(rows, seen, languages, levels, temper=0.3, strength=20.0):
    """Posteriors by hand: rows (doc_id, declared, host), seen (number of trigrams, log likelihoods)."""
    k = len(languages) + 1
    loglik = [[*ll, g * levels[int(np.argmax(ll))]] for g, ll in seen]
    best = [int(np.argmax(ll)) if g else None for (g, _), ll in zip(seen, loglik, strict=True)]
    trust, root, hosts, suffixes = np.ones((k, k)), np.ones(k), {}, {}
    for (d, x, h, aside), b in zip(rows, best, strict=True):
        if b is None:
            continue
        root[b] += 1
        if x is not None and aside:
            trust[languages.index(x) + 1 if x in languages else 0, b] += 1
        suffix = (h or "").rpartition(".")[2] if "." in (h or "") else ""
        suffixes.setdefault(suffix, np.zeros(k))[b] += 1
        if h is not None:
            hosts.setdefault((suffix, h), np.zeros(k))[b] += 1
    root /= root.sum()
    smooth = lambda n, parent: (n + strength * parent) / (n.sum() + strength)
    out = []
    for (d, x, h, _), ll, b in zip(rows, loglik, best, strict=True):
        suffix = (h or "").rpartition(".")[2] if "." in (h or "") else ""
        prior = smooth(hosts[suffix, h], smooth(suffixes[suffix], root)) if (suffix, h) in hosts else root
        said = np.log(trust / trust.sum(axis=0))[languages.index(x) + 1 if x in languages else 0] if x is not None else 0
        total = temper * np.array(ll) + said + np.log(prior)
        p = np.exp(total - total.max())
        out.append(("und", 0.0) if b is None else ([*languages, "und"][int(total.argmax())], p.max() / p.sum()))
    return out


def test_posterior_by_hand(spark):
    random.seed(9)
    rows = [(i, " ".join("".join(random.choices("abcdef" if i % 3 else "defghi", k=4)) for _ in range(random.choice([1, 2, 30]))), random.choice(["a", "a", "b", None, "zz"]) if i % 5 else "ab"[i % 3 == 0], random.choice(["x.com", "y.com", "z.fr", "bare", None]), 0) for i in range(60)]
    rows += [(100, "", "a", "x.com", 0), (None, "abc abd", "b", "z.fr", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    languages = ["a", "b"]
    table = language.fit_text(docs, languages, "lang", 8000)
    seen = {r.row: r for r in language.text_evidence(docs, table, "lang", "source").collect()}
    keyed = docs.select(language.row_key("doc_id", "text", "lang", "source").alias("row"), "doc_id", "lang", "source", language.apart().alias("aside")).collect()
    said = {"a": 1, "b": 2}
    frame = spark.createDataFrame([(said.get(r.declared, 0) if r.declared else None, r.best, r.second, r.grams, r.loglik) for r in seen.values()], "said int, best int, second int, grams long, loglik array<double>")
    levels = language.background_levels(frame, 2)
    want = fused([(r.doc_id, r.lang, r.source, r.aside) for r in keyed], [(seen[r.row].grams, seen[r.row].loglik) for r in keyed], languages, levels)
    got = {r.row: r for r in language.judged(docs, languages).collect()}
    for r, (name, p) in zip(keyed, want, strict=True):
        assert got[r.row].language == name and abs(got[r.row].posterior - p) < 1e-9


def test_chat_blocks_are_bounded(spark):
    rows = [(None, i % 3 or None, f"Question number {i}?") for i in range(60)] + [(WIDE, None, f"It is {i}.") for i in range(60)]
    rows += [(WIDE + 2, 5, "Hi?")] * 60 + [(WIDE + 4, i, f"User: so {i}") for i in range(60)]
    turns = spark.createDataFrame([(c, t, ("user", "assistant")[i % 2], x) for i, (c, t, x) in enumerate(rows)], "conv_id long, turn long, role string, text string")
    blocks = chat.ranked_blocks(turns, 8)
    assert blocks.groupBy("no_conv_id", "conv_id", "b0").count().agg(F.max("count")).first()[0] <= 8
    assert blocks.select("rank").distinct().count() == len(rows)
    model = chat.fit(turns)
    got = [sorted(map(str, chat.parse(turns, model, rows=n, fan_in=3).collect())) for n in (1000, 8)]
    assert got[0] == got[1]
    assert sorted((r.conv_id or 0, r.turn or 0) for r in chat.parse(turns, model).collect()) == sorted((c or 0, t or 0) for c, t, _ in rows)
