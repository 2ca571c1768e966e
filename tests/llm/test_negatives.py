"""op13 against a plain search of all rows, and its SQL twin on the dealt vectors."""

import random

import pytest
from keyloom.llm import negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, positives=5, k=3):
    import math

    fine = []
    for vec_id, x, label, *_ in rows:
        if vec_id is not None and label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            fine.append((vec_id, [math.floor(256 * c) for c in x], label))
    out = []
    for n, (a, x, label) in enumerate(fine):
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), v, lab == label) for m, (v, y, lab) in enumerate(fine) if m != n)
        near = [(-s, v) for s, v, same in scored if same][:positives]
        for ps, p in near:
            fits = [(-s, v) for s, v, same in scored if not same and 50 * ps <= -100 * s <= 95 * ps][:k]
            out += [(a, p, i, v, ps, s) for i, (s, v) in enumerate(fits, 1)]
    return sorted(out)


def vectors(chance, n, labels, dims=4, coarse=False):
    rows = []
    for i in range(n):
        x = [chance.choice([-0.5, 0.0, 0.25, 0.5]) if coarse else chance.uniform(-1, 1) for _ in range(dims)]
        rows.append((chance.randrange(0, 400), x[: chance.choice([dims, dims, dims - 1])], chance.randrange(labels), "x"))
    return rows


ODD = [(None, [0.1, 0.2], 1, "x"), (50, None, 1, "x"), (100, [0.5, None], 1, "x"), (150, [float("nan"), 0.1], 1, "x"), (200, [float("inf"), 0.1], 1, "x"), (250, [0.1, 0.2], None, "x"), (300, [], 2, "x")]


@pytest.mark.parametrize("seed,coarse,labels,per_block", [(1, False, 3, 8192), (2, True, 2, 7), (3, True, 5, 3), (4, False, 1, 16), (5, True, 60, 16)])
def test_equals_plain_search(spark, seed, coarse, labels, per_block):
    rows = vectors(random.Random(seed), 300, labels, coarse=coarse) + ODD
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 50 == 0, per_block=per_block, together=2)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_repeated_rows_and_windows_that_overlap(spark):
    """Positives with one score, with limits one apart, of 0 and below it."""
    rows = [(50, [1.0, 0.0], 0, "x")] + [(i, [s / 256, 0.5], 0, "x") for i, s in enumerate([100, 100, 99, 0, -40, 3], 1)]
    rows += [(1000 + i, [s / 256, -0.5], 1, "x") for i, s in enumerate(range(-60, 120))] + [(50, [1.0, 0.0], 0, "x"), (1001, [60 / 256, 0.0], 1, "x")]
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, positives=8, per_block=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, positives=8)


def test_nothing_to_mine(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(none, F.col("vec_id") % 50 == 0).collect() == []
    no_anchor = spark.createDataFrame([(1, [0.5], 1, "x")], SCHEMA)
    assert negatives.hard_negatives(no_anchor, F.col("vec_id") % 50 == 0).collect() == []
    alone = spark.createDataFrame([(0, [0.5], 1, "x")], SCHEMA)
    assert negatives.hard_negatives(alone, F.col("vec_id") % 50 == 0).collect() == []


def test_scores_beyond_doubles(spark):
    big = 2.0**21
    rows = [(50, [big, 0.5], 0, "x")] + [(i, [big - i, 0.25 * i], i % 3, "x") for i in range(1, 40)]
    got = negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rank string"), F.col("vec_id") % 50 == 0, k=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, k=4)


def test_query_equals_its_sql(spark):
    import duckdb
    from keyloom.llm import queries

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.execute(queries.ORACLE_SQL["op13_hard_negatives"]).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op13_hard_negatives"](spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got) == sorted(want) and got


def test_scores_beyond_longs_are_an_error(spark):
    rows = [(50, [2.0**25], 0), (1, [2.0**25], 0)]
    with pytest.raises(Exception, match="scores must fit a long"):
        negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") % 50 == 0).collect()
