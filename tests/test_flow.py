"""The same hook on every way into a target; files of typed values; byte positions and reading on."""

import os
import random

import pytest
from pyspark.sql import functions as F

from keyloom.functions import structured
from keyloom.functions.keys import KeyNames
from keyloom.operators import sync
from keyloom.operators.buckets import BucketedTarget
from keyloom.operators.flow import Flow, record_hook
from keyloom.sources import lines, readers, sinks

SCHEMA = "key string, type string, ttl_ms long, value string"


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def user_code():
    """As a closure, which travels to the tasks by itself."""

    def upper_or_fail(r):
        if r["value"] == "drop":
            return None
        if r["value"] == "fail":
            try:
                int("x")
            except ValueError as e:
                raise RuntimeError("outer") from e
        return r | {"value": r["value"].upper(), "ttl_ms": None if r["ttl_ms"] == 7 else r["ttl_ms"]}

    return upper_or_fail


FLOW = Flow(record_hook(user_code()), KeyNames.parse("a:=b:"))
DATA = [("a:1", "string", 2**60 + 1, "one"), ("a:2", "hash", 7, "two"), ("a:3", "string", -1, "drop"), ("a:4", "string", -1, "fail"), ("a:5", "bloom", -1, "raw"), ("b:6", "string", -1, "lost")]
WANT = [("b:1", "string", 2**60 + 1, "ONE"), ("b:2", "hash", None, "TWO"), ("b:5", "bloom", -1, "raw")]
FAILED = {("a:4", "failure", "invalid literal for int() with base 10: 'x'"), ("b:6", "failure", sync.COLLIDES)}


@pytest.mark.parametrize("way", ["copy", "live", "repair", "ingest"])
def test_hook_on_every_way(spark, way):
    source = spark.createDataFrame(DATA, SCHEMA).repartition(2)
    target = spark.createDataFrame([("b:9", "string", -1, "stays"), ("b:8", "string", -1, "goes"), ("b:1", "string", -1, "old")], SCHEMA)
    keys = spark.createDataFrame([(k,) for k, *_ in DATA] + [("a:8",)], "key string")
    got, outcomes = {"copy": lambda: FLOW.copy(source, target), "ingest": lambda: FLOW.ingest(source, target), "live": lambda: FLOW.live(keys, source, target), "repair": lambda: FLOW.repair(keys, source, target)}[way]()
    gone = way in ("live", "repair")  # a deletion passes the hook by
    assert rows(got) == sorted([*WANT, ("b:9", "string", -1, "stays"), *([] if gone else [("b:8", "string", -1, "goes")])])
    assert {r for r in rows(outcomes) if r[1] == "failure"} == FAILED
    assert {r[0] for r in rows(outcomes) if r[1] == "success"} == {"b:1", "b:2", "b:5", *(["b:8"] if gone else [])}


def test_hook_errors_of_its_own(spark):
    df = spark.createDataFrame([(b"k\xff", "list", [b"x", None], None)], "key binary, type string, members array<binary>, n long")
    ask = lambda fn: record_hook(fn)(df).first().asDict()
    assert ask(lambda r: r) == {"key": bytearray(b"k\xff"), "type": "list", "members": [bytearray(b"x"), None], "n": None, "reason": None}
    assert "unknown columns: other" in ask(lambda r: r | {"other": 1})["reason"] and "without a key" in ask(lambda r: {"type": "x"})["reason"]


def test_micro_batch_into_buckets(spark, tmp_path):
    source = spark.createDataFrame(DATA, SCHEMA)
    table = BucketedTarget.create(spark.createDataFrame([("b:8", "string", -1, "goes")], SCHEMA), f"{tmp_path}/t", 4)
    keys = spark.createDataFrame([("a:1",), ("a:4",), ("a:8",)], "key string")
    outcomes, failed = FLOW.apply_batch(keys, source, table, 0)
    assert rows(table.read()) == WANT[:1] and rows(outcomes, "key") == [("b:1",), ("b:8",)] and rows(failed, "key") == [("a:4",)]


# ---- files


def typed_records(spark):
    v = structured.VALUES
    schema = "key binary, type string, ttl_ms long, " + ", ".join(f"{n} {t}" for n, t in v.items())
    data = [
        (b"s", "string", 5, b"text", None, None, None, None), (b"\xff", "string", -1, b"\x00\xff", None, None, None, None), (b"j", "json", -1, b'{"a":[1,null]}', None, None, None, None),
        (b"l", "list", -1, None, [b"x", b"", b"\xc3\xa9"], None, None, None), (b"h", "hash", -1, None, None, [(b"f", b"v"), (b"g", b"\n\"")], None, None),
        (b"z", "zset", -1, None, None, None, [(b"m", 1.5), (b"n", float("inf"))], None), (b"x", "stream", 9, None, None, None, None, [("1-0", [(b"f", b"v")]), ("2-0", [])]),
    ]
    return spark.createDataFrame(data, schema)


def test_typed_files(spark, tmp_path):
    records = typed_records(spark)
    bad = spark.createDataFrame([(b"bf", "MBbloom--", -1)], "key binary, type string, ttl_ms long")
    both = records.unionByName(bad, allowMissingColumns=True)
    chunk = spark.createDataFrame(
        [(b"big", "hash", 4, 1, 2, [(b"b", b"2")]), (b"big", "hash", 4, 0, 2, [(b"a", b"1"), (b"b", b"old")]), (b"part", "hash", -1, 0, 2, [(b"a", b"1")])],
        "key binary, type string, ttl_ms long, chunk int, chunks int, fields " + structured.PAIRS,
    )
    rejected = sinks.write_key_records(both, f"{tmp_path}/f", chunk)
    assert {(bytes(r["key"]), r["reason"]) for r in rejected.collect()} == {(b"bf", "a backup cannot hold MBbloom--"), (b"part", "only 1 of the key's 2 chunks arrived")}
    good, wrong = readers.read_key_records(spark, f"{tmp_path}/f", typed=True)
    whole = spark.createDataFrame([(b"big", "hash", 4, [(b"a", b"1"), (b"b", b"2")])], "key binary, type string, ttl_ms long, fields " + structured.PAIRS)
    want = records.unionByName(whole, allowMissingColumns=True)
    assert wrong.collect() == [] and sorted(map(str, good.select(want.columns).collect())) == sorted(map(str, want.collect()))


def write(path, data):
    with open(path, "wb") as f:
        f.write(data)


@pytest.mark.parametrize("block", ["50", "128m"])
def test_positions_of_lines(spark, tmp_path, block):
    chance = random.Random(1)
    os.makedirs(f"{tmp_path}/d")
    want = []
    for n, end in enumerate((b"\n", b"")):
        data = b""
        for i in range(60):
            line = b"" if i % 9 == 0 else "é".encode() * chance.randrange(30) + b"x" * chance.randrange(40) + (b"\r" if i % 4 == 0 else b"")
            want.append((n, len(data), line.removesuffix(b"\r").decode()))
            data += line + b"\n"
        want.append((n, len(data), "last")), write(f"{tmp_path}/d/{n}.txt", data + b"last" + end)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        placed = lines.with_positions(lines.raw_lines(spark, f"{tmp_path}/d"))
        found = [(int(r["file"][-5]), r["byte"], r["line"]) for r in placed.collect()]
        ends = {r["file"][-5]: r["next"] for r in lines.read_up_to(placed).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(found) == sorted(want) and ends == {str(n): os.path.getsize(f"{tmp_path}/d/{n}.txt") for n in (0, 1)}


def test_bad_lines_and_reading_on(spark, tmp_path):
    os.makedirs(f"{tmp_path}/d")
    good = lambda k: b'{"key":"%s","type":"string","value":"v"}\n' % k
    first = good(b"a") + b"\n  \nnot json\n" + good(b"b")
    write(f"{tmp_path}/d/f.jsonl", first)
    at = len(good(b"a")) + 4
    records, bad = readers.read_key_records(spark, f"{tmp_path}/d")
    assert rows(records.select(F.col("key").cast("string"))) == [("a",), ("b",)] and [(r["position"].rpartition("/")[2], r["reason"]) for r in bad.collect()] == [(f"f.jsonl@{at}", "not a JSON record")]
    saved = spark.createDataFrame(lines.read_up_to(lines.with_positions(lines.raw_lines(spark, f"{tmp_path}/d"))).collect(), "file string, next long")
    write(f"{tmp_path}/d/f.jsonl", first + b'{"type":"string"}\n' + good(b"c"))
    write(f"{tmp_path}/d/g.jsonl", good(b"d"))
    records, bad = readers.read_key_records(spark, f"{tmp_path}/d", positions=saved)
    assert rows(records.select(F.col("key").cast("string"))) == [("c",), ("d",)] and [r["position"].rpartition("@")[2] for r in bad.collect()] == [str(len(first))]
    assert rows(readers.read_key_records(spark, f"{tmp_path}/d")[0].select(F.col("key").cast("string"))) == [("a",), ("b",), ("c",), ("d",)]


def test_stream_of_files_gets_positions_by_micro_batch(spark, tmp_path):
    os.makedirs(f"{tmp_path}/d")
    for n in range(3):
        write(f"{tmp_path}/d/{n}.jsonl", b"bad\n" * n + b'{"key":"k%d","type":"string","value":"v"}\n' % n)
    got = []

    def batch(df, n):
        records, bad = readers.key_records(lines.with_positions(df))
        got.append((sorted(bytes(r["key"]) for r in records.collect()), sorted(r["position"].rpartition("/")[2] for r in bad.collect())))

    lines.raw_lines(spark, f"{tmp_path}/d", True, 1).writeStream.foreachBatch(batch).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    assert sorted(got) == [([b"k0"], []), ([b"k1"], ["1.jsonl@0"]), ([b"k2"], ["2.jsonl@0", "2.jsonl@4"])]


def test_field_expiry_as_commands(spark):
    fields = [("a", "1", None), ("b", "2", 11_500), ("c", "3", 12_000), ("d", None, 9_000), ("e", "5", 11_001)]
    df = spark.createDataFrame([("h", 60_000, fields), ("gone", -1, [("d", "1", 10_000)]), ("none", -1, [])], "key string, ttl_ms long, fields array<struct<field: string, value: string, expire_at_ms: long>>")
    got = {}
    for r in structured.field_ttl_commands(df, F.lit(10_000)).orderBy("key", "seq").collect():
        got.setdefault(r["key"], []).append(r["argv"])
    assert got == {
        "h": [["DEL", "h"], ["HSET", "h", "a", "1", "b", "2", "c", "3", "e", "5"], ["HEXPIRE", "h", "2", "FIELDS", "3", "b", "c", "e"], ["PEXPIRE", "h", "60000"]],
        "gone": [["DEL", "gone"]], "none": [["DEL", "none"]],
    }
    kept = [r["argv"] for r in structured.field_ttl_commands(df.filter("key = 'h'"), F.lit(10_000), "STRIP", chunk=3).orderBy("seq").collect()]
    assert kept == [["DEL", "h"], ["HSET", "h", "a", "1", "b", "2", "c", "3"], ["HSET", "h", "d", "null", "e", "5"], ["PEXPIRE", "h", "60000"]]
