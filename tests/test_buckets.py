"""The bucketed target against a full upsert: what a batch touches, replays, interrupted commits, compaction."""

import os
import random

import pytest
from pyspark.sql import functions as F

from keyloom.operators import sync
from keyloom.operators.buckets import BucketedTarget

SCHEMA = "key string, type string, ttl_ms long, value string"


def rows(df):
    return sorted(map(tuple, df.collect()))


def records(spark, ids, value, kind="string"):
    return spark.createDataFrame([(f"k{i}", kind, -1, f"{value}{i}") for i in ids], SCHEMA)


def test_a_batch_touches_the_buckets_of_its_keys(spark, tmp_path):
    old = records(spark, range(2000), "old")
    table = BucketedTarget.create(old, f"{tmp_path}/t", 256)
    assert rows(table.read()) == rows(old) and table.version() == 0
    batch = records(spark, [3, 77, 500, 501, 502, 1999, 2000, 2001], "new").unionByName(records(spark, [5, 6], None, "deleted"))
    before = {f: os.stat(f"{tmp_path}/t/data/commit=0/{f}").st_mtime_ns for f in os.listdir(f"{tmp_path}/t/data/commit=0")}
    outcomes = table.apply(batch, 7)
    wrote = [f for f in os.listdir(f"{tmp_path}/t/data/commit=1") if f.startswith("bucket=")]
    assert len(wrote) == table.manifest().filter("version = 1 and kind = 'delta'").count() <= 10
    assert before == {f: os.stat(f"{tmp_path}/t/data/commit=0/{f}").st_mtime_ns for f in before}
    want, want_outcomes = sync.upsert(batch, old)
    assert rows(table.read()) == rows(want) and rows(outcomes) == rows(want_outcomes)
    assert rows(table.read(version=0)) == rows(old)
    assert table.apply(batch, 7).collect() == [] and table.version() == 1  # replayed


@pytest.mark.parametrize("conflict", ["OVERWRITE", "FAIL"])
def test_many_batches_equal_full_upserts(spark, tmp_path, conflict):
    chance = random.Random(conflict)
    full = records(spark, range(60), "old")
    table = BucketedTarget.create(full, f"{tmp_path}/t", 8, spread=2)
    for n in range(3):
        ids = [chance.randrange(90) for _ in range(20)]
        data = [(f"k{i}", chance.choice(["string", "hash", "deleted"]), n, f"b{n}.{at}", at) for at, i in enumerate(ids)]
        batch = spark.createDataFrame(data, SCHEMA + ", seq int")
        full, want = sync.upsert(batch, full, conflict, ["seq"])
        full = spark.createDataFrame(full.collect(), SCHEMA)
        assert rows(table.apply(batch, n, conflict, ["seq"])) == rows(want)
        assert rows(table.read()) == rows(full)
        if n == 2:
            state, parts = rows(table.read()), len(table.parts())
            assert table.compact(1) > 0 and table.compact(1) == 0
            assert rows(table.read()) == state and len(table.parts()) < parts and len(table.dead()) > 0
    assert rows(table.read(version=0)) == rows(records(spark, range(60), "old"))


def test_an_interrupted_commit_is_not_seen_and_replaced(spark, tmp_path):
    old = records(spark, range(30), "old")
    table = BucketedTarget.create(old, f"{tmp_path}/t", 4)
    records(spark, range(100, 130), "lost").withColumn("bucket", table.bucket()).write.partitionBy("bucket").parquet(f"{tmp_path}/t/data/commit=1")
    assert rows(table.read()) == rows(old)
    table.apply(records(spark, [1], "new"), 0)
    assert rows(table.read()) == rows(sync.upsert(records(spark, [1], "new"), old)[0])


def test_empty_batches_and_tables(spark, tmp_path):
    table = BucketedTarget.create(records(spark, [], "x"), f"{tmp_path}/t", 4)
    assert table.read().collect() == []
    assert table.apply(records(spark, [], "x"), 0).collect() == [] and table.version() == 1
    assert table.apply(records(spark, [], "x"), 0).collect() == [] and table.version() == 1
    table.apply(records(spark, [1], None, "deleted"), 1)
    assert table.read().collect() == [] and table.compact(0) == 1 and table.read().collect() == []
    again = BucketedTarget(spark, f"{tmp_path}/t", table.schema, 4)
    again.apply(records(spark, [1, 2], "v"), 2)
    assert rows(again.read()) == rows(records(spark, [1, 2], "v"))


def test_upsert_refuses_to_pick_among_maps(spark):
    t = spark.createDataFrame([("a", "hash", {"f": "v"})], "key string, type string, value map<string, string>")
    with pytest.raises(ValueError, match="order"):
        sync.upsert(t, t)
    got = sync.upsert(t.withColumn("seq", F.lit(1)), t, order=["seq"])[0]
    assert got.count() == 1
