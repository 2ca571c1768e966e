"""op12: archives written and read back, and damaged ones against a plain sequential reader's expectation."""

import base64
import glob
import hashlib
import os
import random
import zlib
from collections import defaultdict

import pytest
from keyloom.llm import warc

SCHEMA = "page_id long, url string, html string, kind string"
PAGES = [
    (5, "http://a.org/x", "<p>héllo</p>", "x"), (3, "http://a.org/y", "<p>héllo</p>", "x"), (9, None, "<p>héllo</p>", "x"), (4, "http://b/ \r\nEvil: 1", "alone", "x"),
    (7, "u", None, "x"), (6, "u", "", "x"), (8, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\nz", "x"), (None, "u", "alone", "x"), (None, "v", "no ids", "x"),
    (2**55 + 1, "u", "wide", "x"), (2**55 + 2, "u", "wide", "x"), (10, "u", "WARC/1.", "x"), (11, "u", "\x1f\x8b\x08 not gzip", "x"), (12, "u", "long " * 200_000, "x"),
    (13, "u", "twice", "x"), (13, "u", "twice", "x"), (14, "u", "twice", "x"), (-3, "u", "minus", "x"), (-2, "u", "minus", "x"),
]


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute(rows, least=0):
    by = defaultdict(list)
    for page_id, _, html, *_ in rows:
        by[(html or "").encode()].append(page_id)
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        ids = [i for i in by[data] if i is not None]
        first = min(ids) if ids and len(data) >= least else None
        revisit = first is not None and first != page_id
        out.append((page_id, len(data), digest(data), "revisit" if revisit else "response", first if revisit else None))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def result(df):
    good = df.filter("kind = 'record'")
    return [tuple(r) for r in good.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("refers_to")).collect()]


@pytest.mark.parametrize("least,compress", [(0, False), (0, True), (5, False), (10**9, True)])
def test_round_trip(spark, tmp_path, least, compress):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    warc.write_archives(pages, f"{tmp_path}/a", least, compress)
    read = warc.read_archives(spark, f"{tmp_path}/a", compress)
    assert sorted(result(read), key=key) == sorted(brute(PAGES, least), key=key)
    assert read.filter("kind = 'gap'").count() == 0
    payloads = {r["record_id"]: bytes(r["payload"]) for r in read.filter("record_type = 'response'").collect()}
    for page_id, _, html, *_ in PAGES:
        data = (html or "").encode()
        assert payloads.get(warc.record_id(page_id, digest(data)), data) == data
    assert sorted(result(warc.archived(pages, least, compress)), key=key) == sorted(brute(PAGES, least), key=key)


def test_groups_that_are_not_hot_are_joined(spark, tmp_path, monkeypatch):
    chance = random.Random(3)
    rows = [(i, "u", f"page {chance.randrange(60)}" if i % 3 else "hot", "x") for i in range(400)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    decided = {(r["page_id"], r["_first"]) for r in warc.responses(pages, 0, hot=10, small=0).collect()}
    first = {}
    for i, _, html, _ in rows:
        first.setdefault(html, []).append(i)
    assert decided == {(i, min(first[h]) if len(first[h]) > 1 else None) for i, _, h, _ in rows}


def files(path):
    return sorted(glob.glob(f"{path}/part-*"))


def test_files_are_what_other_readers_expect(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(2)
    for compress in (False, True):
        warc.write_archives(pages, f"{tmp_path}/{compress}", 0, compress)
    plain = b"".join(open(f, "rb").read() for f in files(f"{tmp_path}/False"))
    unpacked = b""
    for f in files(f"{tmp_path}/True"):
        data = open(f, "rb").read()
        while data:
            z = zlib.decompressobj(31)
            unpacked += z.decompress(data)
            assert z.eof
            data = z.unused_data
    one = b"WARC/1.1\r\nWARC-Type: "
    assert sorted(plain.split(one)) == sorted(unpacked.split(one))
    os.makedirs(f"{tmp_path}/gz")
    for n, f in enumerate(files(f"{tmp_path}/True")):
        os.rename(f, f"{tmp_path}/gz/{n}.warc.gz")
    read = warc.read_archives(spark, f"{tmp_path}/gz/*.warc.gz", True)
    assert sorted(result(read), key=key) == sorted(brute(PAGES), key=key)


def one_record(n, payload=b"some payload"):
    return warc.record(n, f"http://x/{n}", payload, None, False, "2020-01-01T00:00:00Z") + b"\r\n"


def member(data):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def damaged(compress):
    """name -> (bytes, ids that can be read, gaps as (offset, length))."""
    r = [one_record(i, b"payload %d " % i * 40) for i in range(5)]
    r = [member(x) for x in r] if compress else r
    at = [sum(map(len, r[:i])) for i in range(6)]
    whole = b"".join(r)
    flip = bytearray(whole)
    flip[at[2] + len(r[2]) // 2] ^= 0x55
    head = bytearray(whole)
    head[at[1]] ^= 0x55
    out = {
        "whole": (whole, [0, 1, 2, 3, 4], []),
        "empty": (b"", [], []),
        "flipped byte": (bytes(flip), [0, 1, 3, 4], [(at[2], len(r[2]))]),
        "lost marker": (bytes(head), [0, 2, 3, 4], [(at[1], len(r[1]))]),
        "junk before, between and after": (b"junk" + r[0] + b"\x00" * 9 + r[1] + b"tail", [0, 1], [(0, 4), (4 + at[1], 9), (13 + at[2], 4)]),
        "cut in a record": (whole[: at[4] + 20], [0, 1, 2, 3], [(at[4], 20)]),
        "hole over two records": (whole[: at[1] + 30] + whole[at[3] - 10 :], [0, 3, 4], [(at[1], 40)]),
        "marker at the end": (whole + (warc.MEMBER if compress else warc.PLAIN), [0, 1, 2, 3, 4], [(at[5], 3 if compress else 7)]),
        "half a marker at the end": (whole + b"\x1f\x8b" if compress else whole + b"WARC", [0, 1, 2, 3, 4], [(at[5], 2 if compress else 4)]),
        "only junk": (b"nothing here" * 10, [], [(0, 120)]),
    }
    if not compress:
        size = b"Content-Length: %d\r\n" % int(r[1].split(b"Content-Length: ")[1].split(b"\r\n")[0])
        for name, wrong in (("length too small", b"Content-Length: 3\r\n"), ("length too large", b"Content-Length: 900\r\n"), ("length beyond the file", b"Content-Length: 99999999999\r\n"), ("no length", b"X: 1\r\n")):
            bad = r[1].replace(size, wrong, 1)
            out[name] = (r[0] + bad + b"".join(r[2:]), [0, 2, 3, 4], [(at[1], len(bad))])
    return out


@pytest.mark.parametrize("compress", [False, True])
@pytest.mark.parametrize("block", ["64", "128m"])
def test_salvage(spark, tmp_path, compress, block):
    """Each kind of damage in a file of its own; small blocks split every file over many tasks."""
    cases = damaged(compress)
    names = {}
    os.makedirs(f"{tmp_path}/d")
    for n, (name, (data, *_)) in enumerate(cases.items()):
        names[f"f{n}.warcs"] = name
        with open(f"{tmp_path}/d/f{n}.warcs", "wb") as f:
            f.write(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = warc.read_archives(spark, f"{tmp_path}/d", compress).select("path", "kind", "offset", "length", "reason", warc.page_of("record_id").alias("id")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {name: ([], []) for name in cases}
    for r in sorted(rows, key=lambda r: (r["path"], r["offset"])):
        name = names[os.path.basename(r["path"])]
        if r["kind"] == "gap":
            assert r["reason"]
            found[name][1].append((r["offset"], r["length"]))
        else:
            found[name][0].append(r["id"])
    assert found == {name: (ids, gaps) for name, (_, ids, gaps) in cases.items()}


def test_a_record_inside_a_payload_is_not_read(spark, tmp_path):
    outer = one_record(1, b"before " + one_record(2, b"inner") + b" after")
    os.makedirs(f"{tmp_path}/n")
    with open(f"{tmp_path}/n/a.warc", "wb") as f:
        f.write(outer + one_record(3))
    assert sorted(r[0] for r in result(warc.read_archives(spark, f"{tmp_path}/n"))) == [1, 3]
    with open(f"{tmp_path}/n/a.warc", "wb") as f:  # the outer one is damaged: what it holds comes to light
        f.write(outer.replace(b"before", b"BEFORE") + one_record(3))
    assert sorted(r[0] for r in result(warc.read_archives(spark, f"{tmp_path}/n"))) == [2, 3]


def test_no_pages(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.archived(none).collect() == [] and warc.archived(none, compress=True).collect() == []


def test_query_equals_its_sql(spark):
    import duckdb
    from keyloom.llm import queries

    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    want = con.execute(queries.ORACLE_SQL["op12_warc"]).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op12_warc"](spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got, key=key) == sorted(want, key=key) and got
    con.execute("DROP VIEW pages")
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [r[:3] for r in PAGES])
    assert sorted(con.execute(queries.ORACLE_SQL["op12_warc"]).fetchall(), key=key) == sorted(brute(PAGES), key=key)
