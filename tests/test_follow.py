"""Following shards: sendings and saveable positions against a model that replays everything; a real stream with an interrupted listing."""

import random

import pandas as pd
from pyspark.sql import functions as F

from keyloom.sources import readers
from keyloom.streaming import follow


class Handle:
    """The state of one group in place of a stream's."""

    def __init__(self):
        self.value, self.map = None, {}

    def getValueState(self, name, schema):
        outer = self

        class Value:
            exists = lambda self: outer.value is not None
            get = lambda self: outer.value
            update = lambda self, v: setattr(outer, "value", v)

        return Value()

    def getMapState(self, name, key, value):
        outer = self

        class Map:
            containsKey = lambda self, k: k in outer.map
            getValue = lambda self, k: outer.map[k]
            updateValue = lambda self, k, v: outer.map.__setitem__(k, v)
            removeKey = lambda self, k: outer.map.pop(k)
            iterator = lambda self: iter(list(outer.map.items()))

        return Map()


class Part:
    def __init__(self):
        self.p = follow.ShardPart()
        self.p.init(Handle())

    def feed(self, *rows):
        """Sent (key, offset) and the saveable offset after a micro-batch."""
        frame = pd.DataFrame(rows, columns=["kind", "generation", "offset", "key"])
        out = pd.concat(list(self.p.handleInputRows(("s", 0), iter([frame]), None)))
        last = out[out["kind"] == "position"].iloc[0]
        sent = [(r.key, int(r.offset)) for r in out[out["kind"] == "emit"].itertuples()]
        return sent, None if not last["ready"] else int(last["read"] if pd.isna(last["offset"]) else last["offset"])


def test_a_key_is_sent_once_while_it_waits():
    p = Part()
    assert p.feed(("change", 0, 5, "a"), ("change", 0, 7, "b")) == ([("a", 5), ("b", 7)], 4)
    assert p.feed(("change", 0, 8, "a"), ("change", 0, 9, "a")) == ([], 4)
    assert p.feed(("done", 0, 5, "a")) == ([("a", 9)], 5)  # once more, with its newest offset
    assert p.feed(("done", 0, 7, "b")) == ([], 5)
    assert p.feed(("done", 0, 9, "a")) == ([], 9)
    assert p.feed(("done", 0, 9, "a"), ("change", 0, 11, "c"), ("change", 0, 11, "c")) == ([("c", 11)], 10)


def test_no_position_leaves_before_the_listing_is_over():
    p = Part()
    assert p.feed(("resync", 1, 100, None), ("listed", 1, 100, "a"), ("change", 1, 103, "b")) == ([("a", 100), ("b", 103)], None)
    assert p.feed(("done", 1, 103, "b"), ("done", 1, 100, "a")) == ([], None)
    assert p.feed(("listed", 1, 100, "c"), ("complete", 1, 100, None)) == ([("c", 100)], None)
    assert p.feed(("done", 1, 100, "c")) == ([], 103)


def test_a_newer_resync_voids_an_unfinished_listing():
    p = Part()
    assert p.feed(("resync", 1, 100, None), ("listed", 1, 100, "a"), ("listed", 1, 100, "gone")) == ([("a", 100), ("gone", 100)], None)
    sent, at = p.feed(("resync", 2, 50, None), ("listed", 2, 50, "a"), ("listed", 1, 100, "x"), ("complete", 1, 100, None), ("change", 1, 500, "y"))
    assert sorted(sent) == [("a", 50), ("gone", 50), ("y", 50)] and at is None  # a key that waits is looked at again, as it may be gone
    assert p.feed(("complete", 2, 50, None), ("done", 1, 100, "a"))[1] is None
    assert p.feed(("done", 2, 50, "a"), ("done", 2, 50, "gone"), ("done", 2, 50, "y")) == ([], 50)
    assert p.feed(("change", 1, 900, "z")) == ([], 50) and p.feed(("change", 2, 51, "z")) == ([("z", 51)], 50)


def test_restarts_lose_nothing():
    """Whenever it is stopped, what lies behind the saved position and what is in the target give the source."""
    for seed in range(30):
        chance = random.Random(seed)
        log = [(n, chance.choice("abcdef")) for n in range(1, 60)]
        part, target, way, saved, at = Part(), {}, [], 0, 0
        while at < len(log) or way:
            step = chance.randrange(5)
            rows = [("change", 0, n, k) for n, k in log[at : at + step]]
            at += step
            chance.shuffle(rows)
            acks = [way.pop(chance.randrange(len(way))) for _ in range(min(len(way), chance.randrange(3)))]
            for k, offset in acks:  # written as it is in the source by now
                target[k] = max(n for n, x in log[:at] if x == k)
            sent, saved = part.feed(*rows, *(("done", 0, offset, k) for k, offset in acks)) if rows or acks else ([], saved)
            way += sent
            assert len({k for k, _ in way}) == len(way)  # never twice on the way
            again = dict(target)
            for n, k in log:
                if n > saved:
                    again[k] = max(m for m, x in log if x == k)
            assert again == {k: max(m for m, x in log if x == k) for _, k in log}
        assert saved == log[-1][0] and target == {k: max(m for m, x in log if x == k) for _, k in log}


def test_stream_with_an_interrupted_listing_equals_the_batch_row(spark, tmp_path):
    listing = [("s1", g, 100 * g, f"k{i}") for g in (1, 2) for i in range(g * 4)] + [("s2", 1, 10, "m"), ("s2", 1, 10, "n")]
    changes = [("s1", 1, 150, "old"), ("s1", 1, 999, "void"), ("s1", 2, 205, "k1"), ("s1", 2, 206, "new"), ("s2", 1, 12, "m"), ("s2", 1, 9, "before")]
    first = [("s1", "resync", 1, 100, None), *(("s1", "listed", g, o, k) for s, g, o, k in listing if g == 1 and s == "s1"), ("s1", "change", 1, 150, "old")]
    second = [("s1", "resync", 2, 200, None), *((s, "listed", g, o, k) for s, g, o, k in listing if (s, g) != ("s1", 1)), ("s2", "resync", 1, 10, None), ("s2", "complete", 1, 10, None)]
    third = [("s1", "complete", 2, 200, None), *((s, "change", g, o, k) for s, g, o, k in changes if o not in (150, 9))]
    for n, rows in enumerate((first, second, third)):
        spark.createDataFrame(rows, follow.ROWS).coalesce(1).write.parquet(f"{tmp_path}/in/n={n}")
    positions = follow.position_table(spark, f"{tmp_path}/positions")
    got = []

    def run(step):
        rows = spark.readStream.schema(follow.ROWS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        follow.start(rows, lambda df, n: got.extend(tuple(r) for r in df.select("shard", "generation", "key", "offset").collect()), positions, f"{tmp_path}/ck", parts=2).awaitTermination()
        return {r["shard"]: r["offset"] for r in follow.saveable(positions.read()).collect()}

    assert run(0) == {"s1": None, "s2": None}  # nothing is done yet
    batch = readers.bootstrap_then_follow(
        spark.createDataFrame(listing, "shard string, generation long, offset long, key string"), spark.createDataFrame(changes, "shard string, generation long, offset long, key string"),
    )
    sent = {(s, k) for s, g, k, _ in got if (s, g) != ("s1", 1)} - {("s1", "old")}  # that was waiting when its history became void
    assert sent == {(r["shard"], r["key"]) for r in batch.collect()}
    newest = {}
    for s, g, k, o in got:
        newest[s, k] = (g, o)
    acks = [(s, "done", g, max(o for s2, g2, k2, o in got if (s2, k2, g2) == (s, k, g)), k) for (s, k), (g, _) in newest.items()]
    for n in (3, 4):
        spark.createDataFrame([(s, kind, g, o + (n == 4) * 10, k) for s, kind, g, o, k in acks], follow.ROWS).coalesce(1).write.parquet(f"{tmp_path}/in/n={n}")
        after = run(n)
    assert after == {"s1": 206, "s2": 12}


def test_batch_positions(spark):
    changes = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 5, "x"), ("b", 2, "z"), ("c", 4, "w")], "shard string, offset long, key string")
    done = spark.createDataFrame([("x", 1), ("y", 3), ("z", 9), ("q", 1)], "key string, offset long")
    assert {tuple(r) for r in follow.saveable_offsets(changes, done).collect()} == {("a", 4), ("b", 2), ("c", 3)}


def test_cursor_is_that_of_the_last_row(spark):
    spark.createDataFrame([(i, str(i)) for i in range(1, 12)], "n int, id string").createOrReplaceTempView("texts")
    rows, cursor = readers.read_incremental(spark, "select * from texts where n > ${cursor} order by n", "id", "8")
    assert [r["id"] for r in rows.collect()] == ["9", "10", "11"] and cursor.first()[0] == "11" and rows.columns == ["n", "id"]
    rows, cursor = readers.read_incremental(spark, "select * from texts where id = '${cursor}' order by n", "id", "it's")
    assert rows.collect() == [] and cursor.first()[0] == "it's"
    assert readers.read_incremental(spark, "select * from texts", None, "7")[1].first()[0] == "7"
    assert rows.select(F.lit(1)).count() == 0
