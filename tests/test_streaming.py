"""The same rows through streams and in batch give the same target; chunks and retries keep state."""

import time

import pandas as pd
from pyspark.sql import functions as F

from keyloom.operators import sync
from keyloom.operators.buckets import BucketedTarget
from keyloom.operators.flow import Flow, record_hook
from keyloom.streaming import live


def test_live_apply_equals_batch(spark, tmp_path):
    source = spark.createDataFrame([(f"k{i}", "hash", f"new{i}") for i in range(20)], "key string, type string, value string")
    old = spark.createDataFrame([(f"k{i}", "hash", "old") for i in range(10, 30)], "key string, type string, value string")
    changed = spark.createDataFrame([(f"k{i % 25}",) for i in range(5, 60, 2)], "key string")
    changed.repartition(3).write.parquet(str(tmp_path / "in"))
    target = BucketedTarget.create(old, f"{tmp_path}/target", 8)
    failed = []
    stream = spark.readStream.schema("key string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    flow = Flow(record_hook(lambda r: r | {"value": {"new7": 1 / 0}} if r["key"] == "k7" else None if r["key"] == "k9" else r | {"value": r["value"].upper()}))
    live.apply_changes(stream, lambda: source, target, str(tmp_path / "ck"), flow, lambda df, n: failed.extend(map(tuple, df.collect())), compact=1).awaitTermination()
    want = live.apply_batch(changed.filter("key <> 'k7' and key <> 'k9'"), source.withColumn("value", F.upper("value")), old)[0]
    assert sorted(map(tuple, target.read().collect())) == sorted(map(tuple, want.collect()))
    assert set(failed) == {("k7", "division by zero")}


def until(spark, df, name, tmp_path, rows, seconds=90):
    """Rows of a stream's output as soon as there are so many; timers keep the query alive until then."""
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "ck")).start()
    end = time.time() + seconds
    try:
        while time.time() < end and q.isActive and spark.table(name).count() < rows:
            time.sleep(1)
        if q.exception():
            raise q.exception()
        return spark.table(name).collect()
    finally:
        q.stop()


def test_await_chunks(spark, tmp_path):
    rows = [("a", "list", 1, 2, ["c"]), ("a", "list", 0, 2, ["a", "b"]), ("b", "list", 0, 3, ["x"])]
    spark.createDataFrame(rows, "key string, type string, chunk int, chunks int, items array<string>").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("key string, type string, chunk int, chunks int, items array<string>").parquet(str(tmp_path / "in"))
    got = until(spark, live.await_chunks(s, wait_ms=150, most=3), "chunks_done", tmp_path, 2)
    assert sorted((r.key, r["items"], r.reason) for r in got) == [("a", ["a", "b", "c"], None), ("b", None, "only 1 of the key's 3 chunks arrived")]


class Parts:
    """State, timers and clock of one key's chunks in place of a stream's."""

    def __init__(self, wait_ms, most):
        self.parts, self.state, self.timers, self.now, self.p = {}, None, [], 0, live.ChunkWait(wait_ms, most)
        self.p.init(self)

    getMapState = getValueState = lambda self, name, *schema: self.of(name)
    registerTimer = lambda self, at: self.timers.append(at)
    getCurrentProcessingTimeInMs = getExpiryTimeInMs = lambda self: self.now

    def of(self, name):
        outer = self

        class Map:
            containsKey = lambda self, k: k in outer.parts
            updateValue = lambda self, k, v: outer.parts.__setitem__(k, v)
            iterator = lambda self: iter(list(outer.parts.items()))
            clear = lambda self: outer.parts.clear()

        class Value:
            exists = lambda self: outer.state is not None
            get = lambda self: outer.state
            update = lambda self, v: setattr(outer, "state", v)
            clear = lambda self: setattr(outer, "state", None)

        return Map() if name == "parts" else Value()

    def rows(self, *rows):
        frame = pd.DataFrame([(t, c, n, x if t == "list" else None, x if t == "hash" else None) for t, c, n, x in rows], columns=["type", "chunk", "chunks", "items", "fields"])
        return [d.iloc[0].to_dict() for d in self.p.handleInputRows(("k",), iter([frame]), self)]

    def fire(self):
        self.now = min(self.timers)
        self.timers.remove(self.now)
        return [d.iloc[0]["reason"] for d in self.p.handleExpiredTimer(("k",), self, self)]


def test_chunks_wait_so_often_and_old_timers_do_nothing():
    k = Parts(100, 3)
    assert k.rows(("list", 0, 3, ["a"])) == [] and k.rows(("list", 1, 3, ["b"])) == [] and k.timers == [100]
    assert k.fire() == [] and k.fire() == [] and k.now == 200 and k.fire() == ["only 2 of the key's 3 chunks arrived"] and k.timers == []
    k = Parts(100, 3)
    k.rows(("list", 0, 2, ["a"]))
    k.now = 60
    assert k.rows(("list", 0, 2, ["again"]), ("list", 1, 2, ["b"]))[0]["items"] == ["a", "b"] and k.state is None
    k.now = 70
    assert k.rows(("list", 0, 2, ["c"])) == [] and sorted(k.timers) == [100, 170]  # the next set of the key
    assert k.fire() == [] and k.state == (0, 170)  # of the finished set: it is no wait of this one
    assert k.fire() == [] and k.state == (1, 270)
    pairs = lambda *p: [{"field": f, "value": v} for f, v in p]
    k = Parts(100, 3)
    k.rows(("hash", 1, 2, pairs(("x", "2"), ("z", "3"))))
    assert k.rows(("hash", 0, 2, pairs(("x", "1"), ("y", "0"))))[0]["fields"] == pairs(("x", "2"), ("y", "0"), ("z", "3"))


def test_retry_with_hold(spark, tmp_path):
    rows = [("k", 1, "old", 0, True), ("k", 2, "newer", 0, False), ("z", 1, "v", 5, True), ("y", 1, "v", 0, False)]
    schema = "key string, seq long, value string, tries int, failed boolean"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    got = {(r.key, r.action): r.value for r in until(spark, live.retry_with_hold(s), "retries", tmp_path, 3)}
    assert got == {("z", "gave up"): "v", ("y", "write"): "v", ("k", "write"): "newer"}


class Kept:
    """State, timers and clock of one key in place of a stream's."""

    def __init__(self, hold):
        self.state, self.now, self.timers, self.hold = None, 0, [], hold
        hold.init(self)

    getValueState = lambda self, name, schema: self
    exists = lambda self: self.state is not None
    get = lambda self: self.state
    update = lambda self, row: setattr(self, "state", row)
    clear = lambda self: self.update(None)
    registerTimer = lambda self, at: self.timers.append(at)
    getCurrentProcessingTimeInMs = getExpiryTimeInMs = lambda self: self.now

    def rows(self, *rows):
        frame = pd.DataFrame(rows, columns=["seq", "value", "tries", "failed"])
        return [tuple(r)[1:] for d in self.hold.handleInputRows(("k",), iter([frame]), self) for r in d.itertuples(index=False)]

    def fire(self):
        self.now = min(self.timers)
        self.timers.remove(self.now)
        return [tuple(r)[1:] for d in self.hold.handleExpiredTimer(("k",), self, self) for r in d.itertuples(index=False)]


def test_hold_ends_with_the_outcome_or_in_time():
    def failed_and_out():
        k = Kept(live.RetryHold(2, 100, 30_000, 600_000))
        assert k.rows((1, "a", 0, True), (2, "b", 0, False)) == [] and k.timers == [100]
        assert k.fire() == [(2, "b", 1, "write")] and k.timers == [600_100]
        assert k.rows((3, "c", 0, False), (4, "d", 0, False)) == []
        return k

    k = failed_and_out()
    assert k.fire() == [(4, "d", 0, "write")] and not k.exists()  # no outcome came
    k = failed_and_out()
    assert k.rows((2, "b", 1, False)) == [(4, "d", 0, "write")] and k.fire() == [] and k.rows((5, "e", 0, False)) == [(5, "e", 0, "write")]
    k = failed_and_out()
    assert k.rows((2, "b", 1, True)) == [] and k.fire() == [(4, "d", 2, "write")]  # the newest is tried, after the longer delay
    assert k.now == 300 and k.fire() == [] and k.exists()  # a timer of the first hold does nothing
    assert k.rows((4, "d", 2, True)) == [(4, "d", 3, "gave up")] and not k.exists()
    k = failed_and_out()
    assert k.rows((2, "b", 2, True)) == [(2, "b", 3, "gave up"), (4, "d", 0, "write")]
    k = Kept(live.RetryHold(2, 100, 30_000, 600_000))
    assert k.rows((1, "a", 0, True)) == [] and k.fire() == [(1, "a", 1, "write")] and k.fire() == [] and not k.exists()


def test_delay_repeats(spark):
    df = spark.createDataFrame([("k", n) for n in range(1, 12)], "key string, n int").select(live.retry_delay_ms(F.col("n")).alias("d"))
    d = [r.d for r in df.collect()]
    assert d == [r.d for r in df.collect()] and 80 <= d[0] <= 120 and max(d) <= 36_000


def test_hook(spark):
    df = spark.createDataFrame([("a",), ("b",)], "key string")
    assert sync.with_hook(df, lambda x: x.filter("key = 'a'")).filter("reason is null").count() == 1
