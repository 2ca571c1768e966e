"""Differential passes against full ones, passes that are due, rule tables, watched runs, frequent items."""

import random

from pyspark.sql import functions as F

from keyloom.functions.keys import KeyNames
from keyloom.operators import advice, passes, reconcile, runs, topology
from keyloom.streaming import watch

SCHEMA = "key string, type string, ttl_ms long, size long, value string, unreadable boolean"


def sides(spark, chance, n, change):
    src, tgt = [], []
    for i in range(n):
        row = [f"a:{i}", chance.choice(["string", "hash", "MBbloom--", "vectorset"]), chance.choice([-1, -1, 60_000]), i % 5, f"v{i}", False]
        src.append(tuple(row))
        if chance.random() < change:
            at = chance.randrange(7)
            if at == 0:
                continue
            if at == 6:
                tgt.append(tuple([f"b:x{i}", *row[1:]]))
            elif at > 0:
                row[at] = {1: "zset", 2: chance.choice([-1, 62_000, 99_000]), 3: 9, 4: "other", 5: True}[at]
        tgt.append(tuple([row[0].replace("a:", "b:"), *row[1:6]]))
    return spark.createDataFrame(src, SCHEMA), spark.createDataFrame(tgt, SCHEMA)


def test_differential_pass_equals_full_pass(spark):
    for seed, change in ((1, 0.0), (2, 0.1), (3, 0.5)):
        src, tgt = sides(spark, random.Random(seed), 400, change)
        names = KeyNames.parse("a:=b:")
        for how in ({}, {"only": ["a:1"]}, {"ttl_strategy": "STRIP"}):
            diffs, stats = passes.differential_pass(src, tgt, names, buckets=64, **how)
            want = reconcile.first_differences(src, tgt, names=names, **how)
            assert sorted(map(tuple, diffs.collect())) == sorted(map(tuple, want.collect()))
        row = passes.differential_pass(src, tgt, names, buckets=64)[1].first()
        assert row["source_keys"] == 400 and (row["unlike"] == 0 and row["joined"] == src.filter("ttl_ms > 0").count() if change == 0 else row["unlike"] > 0)


def test_few_differences_join_few_keys(spark):
    src = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), F.lit("string").alias("type"), F.lit(-1).cast("long").alias("ttl_ms"), F.lit(1).cast("long").alias("size"), F.md5(F.col("id").cast("string")).alias("value"))
    tgt = src.withColumn("value", F.when(F.col("key").isin("k7", "k900", "k15000"), "x").otherwise(F.col("value")))
    diffs, stats = passes.differential_pass(src, tgt, buckets=1024)
    assert {tuple(r) for r in diffs.collect()} == {("k7", "value"), ("k900", "value"), ("k15000", "value")} and stats.first()["unlike"] == 3 and stats.first()["joined"] < 120


def test_pass_due(spark):
    done = spark.createDataFrame([(1, 0, 10, "SAMPLE"), (1, 20, 30, "FULL"), (2, 0, None, "SAMPLE"), (3, 0, None, "FULL"), (4, 0, 99, "SAMPLE"), (6, 50, 60, "FULL")], "run_id int, started_at long, finished_at long, mode string")
    asked = spark.createDataFrame([(1, 15, "before"), (2, 5, "a flush"), (2, 7, "a size drop"), (3, 5, "a flush"), (5, 1, "a flush"), (6, 55, "meanwhile")], "run_id int, at long, trigger string")
    now = spark.createDataFrame([(i, 100) for i in range(1, 8)], "run_id int, now long")
    got = {tuple(r) for r in passes.pass_due(done, asked, now, 60).collect()}
    assert got == {(1, "SAMPLE", "schedule"), (2, "FULL", "a size drop"), (5, "FULL", "a flush"), (6, "FULL", "meanwhile"), (7, "SAMPLE", "schedule")}


def test_rule_operators(spark):
    m = spark.createDataFrame([(1, "7.4.2", None, ["a", "b"], {"x": 1}), (2, "6.10", "E", None, {})], "source int, version string, text string, list array<string>, held map<string, int>")
    rules = [
        advice.Rule("a", "since", (("version", "since", "7.4.0"),)), advice.Rule("a", "older", (("version", "older", "6.11.0"),)), advice.Rule("a", "null {text}", (("text", "null", True),)),
        advice.Rule("a", "has", (("list", "has", "b"),)), advice.Rule("a", "any", (("held", "has", ("y", "x")),)), advice.Rule("a", "lacks", (("list", "lacks", "b"),)),
        advice.Rule("a", "both", (("source", ">=", 2), ("text", "matches", "^E"))), advice.Rule("a", "in", (("source", "in", (1, 5)), ("source", "<>", 7), ("source", "<", 2), ("source", "=", 1), ("source", ">", 0), ("source", "<=", 1))),
        advice.Rule("a", "never", (("text", "<>", "x"), ("text", "null", True)), (2,)),
    ]
    got = {r["source"]: [x["text"] for x in r["f"]] for r in m.select("source", advice.compiled(rules, m).alias("f")).collect()}
    assert got == {1: ["since", "null none", "has", "any", "in"], 2: ["older", "lacks", "both"]}


def test_stream_drift_equals_batch(spark, tmp_path):
    chance = random.Random(4)
    rows = []
    for run in ("a", "b"):
        for n in range(6):
            rows.append([(run, f"s{n}", f"n{i}", sorted(chance.sample(range(12), 3))) for i in range(5) if chance.random() < 0.7 or i == 0])
    schema = "run_id string, snapshot_id string, node_id string, slots array<int>"
    every = spark.createDataFrame([r for part in rows for r in part], schema)
    for n in range(3):  # two snapshots of each run at a time
        spark.createDataFrame([r for k, part in enumerate(rows) if k % 6 // 2 == n for r in part], schema).coalesce(1).write.parquet(f"{tmp_path}/in/n={n}")
    spark.createDataFrame([("a", "s1", "n0", [1])], schema).coalesce(1).write.parquet(f"{tmp_path}/in/n=3")
    got = []
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = watch.drift_alerts(stream).writeStream.foreachBatch(lambda df, n: got.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    late = ("a", "s1", None, None, None, "REFUSED")
    assert late in got and sorted(r for r in got if r != late) == sorted(map(tuple, topology.drift(every).collect()))


def test_counters_equal_a_batch_count(spark, tmp_path):
    rows = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, "filtered").when(F.col("id") % 7 == 0, "failure").otherwise("changed").alias("route"))
    rows.repartition(4).write.parquet(f"{tmp_path}/in")
    history = watch.RunHistory()
    spark.streams.addListener(history)
    try:
        stream = spark.readStream.schema("id long, route string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        seen = watch.counted(stream, "r1", **{n: F.col("route") == n for n in ("changed", "filtered", "failure")})
        seen.filter("route = 'changed'").writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
        import time

        for _ in range(50):
            if len(history.seen) >= 4:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(history)
    history.save(spark, f"{tmp_path}/h"), history.save(spark, f"{tmp_path}/h")
    got = {r["name"]: r["total"] for r in watch.totals(spark.read.parquet(f"{tmp_path}/h")).collect()}
    assert got == {r["route"]: r["n"] for r in rows.groupBy("route").agg(F.count("*").alias("n")).collect()}


def test_frequent_items_over_runs(spark):
    chance = random.Random(2)
    few = [(run, f"i{min(int(chance.paretovariate(1)), 60)}") for run in range(4) for _ in range(500)]
    exact = spark.createDataFrame(few, "run_id int, item string").groupBy("item").agg(F.count("*").alias("n"))
    got = runs.frequent_items(runs.item_sketches(spark.createDataFrame(few, "run_id int, item string"), 128), 5, 128).collect()
    assert {tuple(r) for r in got} <= {tuple(r) for r in exact.collect()} and sorted((r["n"] for r in got), reverse=True) == [r["n"] for r in exact.orderBy(F.desc("n")).limit(5).collect()]
    many = spark.range(40_000).select((F.col("id") % 4).cast("int").alias("run_id"), F.when(F.col("id") % 5 < 2, F.col("id") % 3).otherwise(F.col("id")).cast("string").alias("item"))
    count = {r["item"]: r["n"] for r in many.groupBy("item").agg(F.count("*").alias("n")).collect()}
    got = runs.frequent_items(runs.item_sketches(many, 512), 3, 512).collect()
    assert {r["item"] for r in got} == {"0", "1", "2"} and all(0 <= r["n"] - count[r["item"]] <= 40_000 * 3.5 / 512 for r in got)


def test_rates(spark):
    s = spark.createDataFrame([("r", t, 100, n) for t, n in ((0, 0), (10, 50), (20, 50), (700, 50), (710, 100))], "run_id string, t long, source long, target long").withColumn("ts", F.timestamp_seconds("t"))
    got = [(r["t"], r["rate"], r["state"]) for r in runs.rates(s, 5, 600).orderBy("t").collect()]
    assert got == [(0, None, "copying"), (10, 5.0, "copying"), (20, 0.0, "copying"), (700, 0.0, "timed_out"), (710, 5.0, "caught_up")]
