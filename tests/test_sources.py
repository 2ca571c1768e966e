"""Delimited files as records, events from files and messages, lookups that fail, streams with groups."""

import datetime

import pytest

from keyloom.functions import structured
from keyloom.operators import sync
from keyloom.sources import readers

STREAM = f"key binary, type string, ttl_ms long, text binary, members array<binary>, fields {structured.PAIRS}, scored {structured.SCORED}, entries {structured.ENTRIES}, last_id string, groups {structured.GROUPS}"


def test_records_of_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("id\tname\n1\tx\n2\t\n")
    (tmp_path / "b.tsv").write_text("id\tname\n3\tx\n\ty\n")
    good, bad = readers.ingest_records(spark, str(tmp_path), "id", key_prefix="orders", file_type="tsv")
    assert sorted((r.key, r.type, [tuple(f) for f in r.value]) for r in good.collect()) == [
        ("orders:1", "hash", [("id", "1"), ("name", "x")]), ("orders:2", "hash", [("id", "2"), ("name", "null")]),
    ]
    assert bad.count() == 2  # the row without its key, and with it all of its file
    good, _ = readers.ingest_records(spark, str(tmp_path / "a.tsv"), "id", "json", file_type="tsv", ttl_ms=5)
    assert sorted((r.key, r.type, r.ttl_ms) for r in good.collect()) == [("1", "json", 5), ("2", "json", 5)]
    with pytest.raises(ValueError, match="no field key"):
        readers.ingest_records(spark, str(tmp_path), "key", file_type="tsv")
    with pytest.raises(ValueError, match="hash or json"):
        readers.ingest_records(spark, str(tmp_path), "id", "list", file_type="tsv")


def test_events_of_files_and_messages(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"channel":"__keyevent@0__:del","message":"k","more":1}\nno JSON\n{"message":"k"}\n')
    seen = sync.route_events(readers.read_events(spark, str(tmp_path), stream=False, file_format="json"))
    assert sorted((r.route, r.key) for r in seen.collect() if r.route != "failure") == [("deleted", "k")]
    assert seen.filter("route = 'failure'").count() == 2
    at = datetime.datetime(2024, 1, 1)
    log = spark.createDataFrame([(bytearray(b"__keyspace@3__:k"), bytearray(b"set"), at, 7), (None, bytearray(b"x"), at, 8)], "key binary, value binary, timestamp timestamp, offset long")
    seen = sync.route_events(readers.events_of_messages(log)).select("db", "key", "route", "ts").collect()
    assert {tuple(r)[:3] for r in seen} == {(3, "k", "changed"), (None, None, "failure")} and {r.ts for r in seen} == {at}


def test_lookups_that_fail(spark):
    keys = spark.createDataFrame([("a:1",), ("a:2",), ("a:3",), ("x:1",), ("",), (None,), ("a:4",), ("a:1",)], "key string")
    answers = spark.createDataFrame([("a:1", None), ("a:2", "slow"), ("x:1", "slow"), ("a:4", "slow"), ("a:4", None), (None, None)], "key string, error string")
    got = sync.existence_routes(keys, answers, deny=["x:"]).collect()
    assert sorted((r.key or "", r.route, r.reason) for r in got if r.reason) == [("", "failure", "no key"), ("", "failure", "no key"), ("a:2", "failure", "the source could not be asked: slow")]
    assert sorted((r.key, r.route) for r in got if not r.reason) == [("a:1", "exists"), ("a:1", "exists"), ("a:3", "missing"), ("a:4", "exists"), ("x:1", "filtered")]
    assert sync.existence_routes(keys.limit(0), answers).count() == 0
    assert {r.route for r in sync.existence(keys, answers.limit(0)).collect()} == {"missing", "failure"}


def test_groups_in_envelopes(spark):
    pending = [("1-0", b"c", 1000, 2)]
    data = [
        (b"text", "stream", 9, None, None, None, None, [("1-0", [(b"f", b"v")])], "3-0", [(b"g", "1-0", 1, [b"c", b"d"], pending), (b"h", None, None, None, None)]),
        (b"bytes", "stream", -1, None, None, None, None, [("1-0", [(b"f", b"v")])], None, [(b"g", "0", None, [b"\xff"], [])]),
        (b"drained", "stream", -1, None, None, None, None, [], "5-0", []),
        (b"none", "stream", -1, None, None, None, None, [("1-0", [])], None, None),
        (b"string", "string", -1, b"x", None, None, None, None, None, None),
    ]
    lines = structured.to_typed_envelope(spark.createDataFrame(data, STREAM)).cache()
    assert lines.filter("line like '%\"base64\":true%'").count() == 1  # one name that is no text makes all of its record base64
    good, bad = structured.from_typed_envelope(lines, groups=True)
    assert bad.count() == 0
    plain = lambda x: tuple(map(plain, x)) if isinstance(x, (list, tuple)) else bytes(x) if isinstance(x, bytearray) else x
    got = {bytes(r.key): (plain(r.entries), r.last_id, plain(r.groups)) for r in good.collect()}
    assert got == {k: (plain(entries), last, plain(groups)) for k, *_, entries, last, groups in data}
    without, _ = structured.from_typed_envelope(lines)  # readers that know nothing of groups still read the rest
    assert without.count() == 5 and "groups" not in without.columns
    spoilt = spark.createDataFrame([('{"key":"k","type":"stream","ttl_ms":-1,"groups":"x","value":[]}',)], "line string")
    assert [r.reason for r in structured.from_typed_envelope(spoilt, groups=True)[1].collect()] == ["not the groups of a stream"]
