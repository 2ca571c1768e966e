"""Key names, scope, expiry, values and applying records, by the fixtures' small tables."""

import pytest
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.functions import structured as ST
from keyloom.functions import values as V
from keyloom.operators import assess, indexes, modules, reconcile, runs, sync, topology
from keyloom.sources import readers, sinks


def column(spark, rows, f, schema="key string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(f(F.col(schema.split()[0]))).collect()]


def test_key_names(spark):
    n = K.KeyNames.parse("user:=account:,user:admin:=staff:", "app", ":")
    given = ["user:1", "user:admin:2", "account:3", "staff:4", "order:5", ""]
    want = ["app:account:1", "app:staff:2", None, None, "app:order:5", "app:"]
    assert column(spark, given, n.to_target) == want
    back = column(spark, [w for w in want if w] + ["order:5", "app:user:9"], n.to_source)
    assert back == ["user:1", "user:admin:2", "order:5", "", None, None]
    swap = K.KeyNames.parse("a:=b:,b:=a:")
    assert column(spark, ["a:1", "b:1", "c"], swap.to_target) == ["b:1", "a:1", "c"]
    assert n.target_prefixes("user:") == ["app:account:", "app:staff:"]
    assert n.target_prefixes("order:") == ["app:order:"]


@pytest.mark.parametrize("rules", ["a", "a=", "a=x,a=y", "a=x,b=xy"])
def test_refused_rules(rules):
    with pytest.raises(ValueError):
        K.KeyNames.parse(rules)


@pytest.mark.parametrize(
    "glob, yes, no",
    [("user:*", ["user:", "user:1\n2"], ["use"]), ("h?llo", ["hello"], ["hllo"]), ("h[ae]llo", ["hallo"], ["hillo"]), ("h[^e]llo", ["hallo"], ["hello"]), ("a\\*", ["a*"], ["ab"]), ("a[b", ["a[b"], ["ab"]), ("a.b", ["a.b"], ["axb"]), ("a", ["a"], ["a\n"]), ("[[a]x", ["[x", "ax"], ["x"]), ("[a&&b]", ["&"], ["c"]), ("[^]x", ["ax"], ["x"]), ("[]x", [], ["x", "]x"]), ("[a-c]", ["b"], ["-"]), ("[\\^a]", ["^", "a"], ["b"])],
)
def test_glob(spark, glob, yes, no):
    assert column(spark, yes + no, lambda c: K.glob_match(c, glob)) == [True] * len(yes) + [False] * len(no)


def test_types_and_scope(spark):
    assert K.resolve_types(["json", "SortedSet"], exact_top_k=True) == ["ReJSON-RL", "zset", "TopK-TYPE"]
    assert "list" not in K.resolve_types(disallow=["list"])
    with pytest.raises(ValueError):
        K.resolve_types(["hash"], disallow=["HASH"])
    assert column(spark, ["a:1", "a:x:1", "b"], lambda c: K.allows_key(c, deny=["a:x"], only=["a:"])) == [True, False, False]
    assert column(spark, ["a:1", "b"], K.allows_key) == [True, True]


def test_slots(spark):
    got = column(spark, ["123456789", "foo", "{user1000}.following", "{user1000}.followers", "foo{}{bar}", ""], K.slot_of)
    assert got[:2] == [12739, 12182] and got[2] == got[3] and got[5] == 0


def test_envelope_round_trip(spark):
    rows = [(b"k", "string", -1, "grün".encode()), (b"\xff\x00", "string", 5, b"\xfe" * 90), (b"e", "string", None, b"")]
    df = spark.createDataFrame(rows, "key binary, type string, ttl_ms long, value binary")
    good, bad = V.from_envelope(V.to_envelope(df))
    assert sorted((bytes(r.key), r.type, r.ttl_ms, bytes(r.value)) for r in good.collect()) == sorted(rows)
    lines = spark.createDataFrame([("",), ("  ",), ("{no",), ('{"type":"x"}',), ('{"key":"a"}',)], "line string")
    assert sorted(r.reason for r in V.from_envelope(lines)[1].collect()) == ["no key", "no type", "not a JSON record"]
    assert bad.count() == 0


def test_jsonl_files(spark, tmp_path):
    df = spark.createDataFrame([(b"k", "string", -1, b"v"), (b"m", "MBbloom--", -1, b"v")], "key binary, type string, ttl_ms long, value binary")
    rejected = sinks.write_key_records(df, str(tmp_path / "b"))
    assert [r.reason for r in rejected.collect()] == ["a backup cannot hold MBbloom--"]
    assert readers.read_key_records(spark, str(tmp_path / "b"))[0].count() == 1


def test_chunks(spark):
    df = spark.createDataFrame([("a", "list", list("abcdefg")), ("b", "list", []), ("c", "set", list("xyz"))], "key string, type string, items array<string>")
    c = V.split_chunks(df, "items", {"list": 3})
    assert c.count() == 5
    done, waiting, failed = V.join_chunks(c, "items")
    assert {r.key: r["items"] for r in done.collect()} == {"a": list("abcdefg"), "b": [], "c": list("xyz")}
    part = c.filter("not (key = 'a' and chunk = 1)")
    assert [r.reason for r in V.join_chunks(part, "items")[1].collect()] == ["only 2 of the key's 3 chunks arrived"]
    assert V.join_chunks(part, "items", waits=10)[2].count() == 1


def test_commands(spark):
    rows = [("h", "hash", 50, ["f", "1", "g", "2", "i", "3"]), ("s", "string", 9, ["v"]), ("d", "deleted", -1, []), ("t", "set", -1, ["x"])]
    got = V.render_commands(spark.createDataFrame(rows, "key string, type string, ttl_ms long, items array<string>"), chunk=2)
    argv = {}
    for r in got.orderBy("key", "seq").collect():
        argv.setdefault(r.key, []).append(" ".join(r.argv))
    assert argv == {"h": ["DEL h", "HSET h f 1 g 2", "HSET h i 3", "PEXPIRE h 50"], "s": ["SET s v PX 9"], "d": ["DEL d"], "t": ["DEL t", "SADD t x"]}


KV = "key string, type string, ttl_ms long, size long, value string"


def test_reconcile_and_repairs(spark):
    src = spark.createDataFrame([("same", "hash", -1, 1, "v"), ("type", "hash", -1, 1, "v"), ("ttl", "set", 9000, 1, "v"), ("near", "set", 9000, 1, "v"), ("size", "set", -1, 2, "v"), ("value", "set", -1, 1, "v"), ("gone", "set", -1, 1, "v"), ("null", "set", None, 1, None)], KV)
    tgt = spark.createDataFrame([("same", "hash", -1, 1, "v"), ("type", "set", -1, 1, "v"), ("ttl", "set", -1, 1, "v"), ("near", "set", 5000, 1, "v"), ("size", "set", -1, 1, "v"), ("value", "set", -1, 1, "w"), ("extra", "set", -1, 1, "v"), ("null", "set", None, 1, None)], KV)
    diffs = reconcile.first_differences(src, tgt)
    assert {r.key: r.reason for r in diffs.collect()} == {k: k for k in ("type", "ttl", "size", "value")} | {"gone": reconcile.MISSING, "extra": reconcile.EXTRA}
    assert reconcile.first_differences(src, tgt, spare=K.allows_key(F.col("key"), only=["ex"])).filter("key = 'extra'").count() == 0
    _, passes, left = sync.reconcile_until_clean(src, tgt)
    assert (passes, left) == (2, 0)
    one = sinks.report(diffs, 8, "FULL", "by hand").first()
    assert one.total == 6 and one.counts["type"] == 1 and len(one.examples) == 6
    assert sinks.report_lines(sinks.report(diffs, 8, "FULL", "by hand"), "md").count() == 5 + 6 + 6
    empty = sinks.report(diffs.limit(0), 0, "FULL", "none").first()
    assert empty.total == 0 and empty.examples == []


def test_module_types_and_scope(spark):
    src = [("u:mod", "MBbloom--", -1, 1, "v"), ("u:vec", "vectorset", -1, 1, "v"), ("u:bloom", "MBbloom--", 9000, 1, "v"), ("u:json", "ReJSON-RL", -1, 1, "v"), ("u:list", "list", -1, 1, "v"), ("u:bad", "hash", -1, 1, "v"), ("o:1", "hash", -1, 1, "v"), ("a:1", "hash", -1, 1, "v")]
    tgt = [("a:bloom", "MBbloom--", 9000, 5, "w", False), ("a:json", "ReJSON-RL", 100, 5, "w", False), ("a:bad", "hash", -1, 1, "v", True), ("a:gone", "set", -1, 1, "v", False), ("x:1", "set", -1, 1, "v", False)]
    src, tgt = spark.createDataFrame(src, KV), spark.createDataFrame(tgt, KV + ", unreadable boolean")
    found = reconcile.compare(src, tgt, K.KeyNames.parse("u:=a:"), only=["u:"], types=["MBbloom--", "vectorset", "ReJSON-RL", "hash"])
    assert {r.key: r.reason for r in found.collect() if r.reason} == {"u:json": "ttl", "u:bad": "unreadable", "u:gone": reconcile.EXTRA}
    assert tuple(reconcile.pass_totals(found).first()) == (3, 3, 1)  # not asked for: list; not held: vectors; only to be restored: one
    aged = reconcile.compare(src.filter("key = 'u:json'"), tgt.filter("key = 'a:json'"), K.KeyNames.parse("u:=a:"), ttl_strategy="RESET", ttl_offset_ms=100)
    assert [r.reason for r in aged.collect()] == [None]


def test_binary_prefixes(spark):
    n = K.KeyNames.parse("é:=x:", "ü", ":")
    text = spark.createDataFrame([("é:1",), ("b",)], "key string")
    raw = text.select(F.encode("key", "UTF-8").alias("key"))
    for df in (text, raw):
        named = df.select(n.to_target(F.col("key")).cast("string").alias("t"), n.to_source(n.to_target(F.col("key"))).cast("string").alias("s")).collect()
        assert [tuple(r) for r in named] == [("ü:x:1", "é:1"), ("ü:b", "b")]


def test_numbers_without_a_group_in_one_task(spark):
    from keyloom.operators.ranks import numbered

    rows = [("all" if i % 3 else "few", (i * 7919) % 1000) for i in range(1000)]
    got = numbered(spark.createDataFrame(rows, "g string, x int"), ["g"], ["x"]).collect()
    for g in ("all", "few"):
        assert [r.x for r in sorted((r for r in got if r.g == g), key=lambda r: r.n)] == sorted(x for k, x in rows if k == g)
        assert sorted(r.n for r in got if r.g == g) == list(range(1, 1 + sum(k == g for k, _ in rows)))
    assert numbered(spark.createDataFrame([], "g string, x int"), ["g"], ["x"]).count() == 0


def test_database_over_spans(spark):
    log = [("s", 1, i, ["SELECT", str(i % 5)] if i % 40 == 3 else ["SET", "a"]) for i in range(1, 200)] + [("s", 2, i, ["SET", "a"]) for i in range(1, 9)]
    df = spark.createDataFrame(log, "shard string, generation long, offset_after long, argv array<string>")
    want, db = {}, 0
    for s, g, i, argv in log:
        db = 0 if (g, i) == (2, 1) else int(argv[1]) if argv[0] == "SELECT" else db
        want[g, i] = db
    for span in (1, 7, 1000):
        assert {(r.generation, r.offset_after): r.db for r in sync.with_database(df, span).collect()} == want


def test_repeated_records(spark):
    new = spark.createDataFrame([("k", "hash", -1, 1, "old"), ("k", "hash", -1, 2, "new")], KV)
    t, out = sync.upsert(new, new.limit(0), order=["size"])
    assert [r.value for r in t.collect()] == ["new"] and out.count() == 1
    first = sync.dead_letters(spark.createDataFrame([("k", 0, "a", 1, 0), ("k", 0, "b", 2, 0)], "key string, chunk int, reason string, failed_at long, seq long"))
    again = sync.dead_letters(spark.createDataFrame([("k", 0, "c", 3, 0)], "key string, chunk int, reason string, failed_at long, seq long"), existing=first)
    assert [(r.reason, [h.reason for h in r.history]) for r in again.collect()] == [("c", ["b", "a"])]


def test_conflicts(spark):
    tgt = spark.createDataFrame([("taken", "hash", -1, 1, "old"), ("gone", "hash", -1, 1, "old")], KV)
    new = spark.createDataFrame([("taken", "hash", -1, 1, "new"), ("free", "hash", -1, 1, "new"), ("gone", "deleted", -1, 0, None)], KV)
    for how, value, outcome in (("OVERWRITE", "new", "success"), ("SKIP", "old", "skipped"), ("FAIL", "old", "failure")):
        t, out = sync.upsert(new, tgt, how)
        assert {r.key: r.value for r in t.collect()} == {"taken": value, "free": "new"}
        assert {r.key: r.outcome for r in out.collect()} == {"taken": outcome, "free": "success", "gone": "success"}
    left, done = sync.apply_deletes(spark.createDataFrame([("taken",), ("none",), (None,)], "key string"), tgt)
    assert [r.key for r in left.collect()] == ["gone"] and sorted(r.outcome for r in done.collect()) == ["failure", "success", "success"]


def test_a_target_of_parts_meets_the_records_in_one_join(spark):
    tgt = [("a", "hash", -1, 1, "old"), ("a", "hash", -1, 2, "twice"), ("b", "set", -1, 1, "old"), ("c", None, -1, 1, "old"), (None, "hash", -1, 1, "no key"), ("x", "list", -1, 1, "old"), ("y", "list", -1, 1, "old")]
    new = [("a", "hash", -1, 1, "new"), ("a", "hash", -1, 1, "newer"), ("b", "deleted", -1, 0, None), ("c", "hash", -1, 1, "new"), (None, "hash", -1, 1, "new"), ("free", "set", -1, 1, None), ("free", "set", -1, 1, "v"), ("x", None, -1, 1, "v"), ("none", None, -1, 1, "v"), ("lost", "deleted", -1, 0, None)]
    ranked = {r[0]: r for r in sorted(new, key=lambda r: [(v is not None, v) for v in r])}  # the largest of a key, nulls first
    target = spark.createDataFrame(tgt[:4], KV).unionByName(spark.createDataFrame(tgt[4:], KV)).filter("size > 0")
    records = spark.createDataFrame(new, KV)
    for how, lost in (("OVERWRITE", "success"), ("SKIP", "skipped"), ("FAIL", "failure")):
        there = {t[0] for t in tgt} - {None}
        outcome = {k: lost if k in there and r[1] not in (None, "deleted") else "success" for k, r in ranked.items()}
        done = {k for k, v in outcome.items() if v == "success"}
        want = [t for t in tgt if t[0] is None or t[0] not in done] + [ranked[k] for k in done if ranked[k][1] not in (None, "deleted")]
        got, out = sync.upsert(records, target, how)
        assert got.columns == target.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
        assert {r.key: r.outcome for r in out.collect()} == outcome
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == (1 if how == "OVERWRITE" else 2)  # the records' kept part asks what is there


def test_dead_letters(spark):
    rows = [("k", 0, None if i == 29 else f"r{i}", i, i) for i in range(30)] + [("k", 1, "other", 1, 1)]
    d = {(r.key, r.chunk): r for r in sync.dead_letters(spark.createDataFrame(rows, "key string, chunk int, reason string, failed_at long, seq long")).collect()}
    assert d["k", 0].reason == "no reason recorded" and [h.reason for h in d["k", 0].history] == [f"r{i}" for i in range(28, 8, -1)]
    assert d["k", 1].history == []


def test_events_and_log(spark):
    ev = [("__keyevent@0__:del", "k"), ("__keyspace@3__:k:1", "set"), ("__keyevent@0__:expired", "x"), ("junk", "k"), ("__keyevent@0__:set", "tmp:1")]
    got = sync.route_events(spark.createDataFrame(ev, "channel string, message string"), deny=["tmp:"]).collect()
    assert [(r.key, r.db, r.route) for r in got] == [("k", 0, "deleted"), ("k:1", 3, "changed"), ("x", 0, "expired"), (None, None, "failure"), ("tmp:1", 0, "filtered")]
    log = [("s", 1, 1, ["SET", "a", "1"]), ("s", 1, 2, ["SELECT", "2"]), ("s", 1, 3, ["SET", "b", "1"]), ("s", 2, 1, ["MSET", "c", "1", "d", "2"]), ("s", 2, 2, ["XGROUP", "SETID", "o", "g", "0"]), ("s", 2, 3, ["ODD", "q"]), ("s", 2, 4, ["COPY", "x", "y", "DB", "0"])]
    log = spark.createDataFrame(log, "shard string, generation long, offset_after long, argv array<string>")
    table = spark.createDataFrame([("set", 1, 1, 1, False), ("mset", 1, -1, 2, False), ("xgroup", 0, 0, 0, False), ("xgroup|setid", 2, 2, 1, False), ("select", 0, 0, 0, False), ("copy", 1, 2, 1, False)], "name string, first int, last int, step int, movable boolean")
    keys, open_ = sync.changed_keys(log, table)
    assert sorted(r.key for r in keys.collect()) == ["a", "c", "d", "o", "x", "y"] and [r.argv[0] for r in open_.collect()] == ["ODD"]


def test_topology(spark):
    r = spark.createDataFrame([(0, 0, 99), (1, 150, 16383)], "node_id int, start int, end int")
    assert [(x.start, x.end) for x in topology.slot_gaps(r).collect()] == [(100, 149)]
    assert sorted((x.node_id, x.start, x.end) for x in topology.to_ranges(topology.from_ranges(r), ["node_id"]).collect()) == [(0, 0, 99), (1, 150, 16383)]
    a = spark.createDataFrame([("n1", 1), ("n1", 2), ("n2", 3)], "node_id string, slot int")
    b = spark.createDataFrame([("n1", 1), ("n3", 2), ("n3", 3)], "node_id string, slot int")
    assert {x.node_id: x.change for x in topology.topology_diff(a, b).collect()} == {"n1": "reassigned", "n2": "departed", "n3": "joined"}
    nodes = spark.createDataFrame([("a", "master", False, False, 0, 99)], "node_id string, role string, failed boolean, migrating boolean, start int, end int")
    assert topology.slot_health(nodes).first().reason == "16284 slots uncovered"
    shards = spark.createDataFrame([("s", ["r1", "r2"]), ("t", [])], "shard string, repl_ids array<string>")
    pos = spark.createDataFrame([("r1", 5, True), ("r2", 3, False)], "repl_id string, offset long, active boolean")
    assert {x.shard: x.offset for x in topology.resume_positions(shards, pos).collect()} == {"s": 3, "t": None}


def test_modules_indexes_assessment(spark):
    plan = modules.topk_plan(spark.createDataFrame([("k", "a", 250000), ("k", "b", 1), ("k", "c", 0)], "key string, item string, count long")).collect()
    assert sorted((r.item, r.incr) for r in plan) == [("a", 50000), ("a", 100000), ("a", 100000), ("b", 1)]
    f = spark.createDataFrame([("i", 2, "$.b", "b", "tag", None), ("i", 1, "a", "a", "TEXT", ["NOSTEM"]), ("j", 1, "z", "z", "odd", None)], "index string, position int, identifier string, attribute string, kind string, options array<string>")
    args = {r["index"]: (r.args, r.supported) for r in indexes.index_args(f).collect()}
    assert args == {"i": (["a", "TEXT", "NOSTEM", "$.b", "AS", "b", "TAG"], True), "j": ([], False)}
    d = spark.createDataFrame([("i", ["user:", "x:"])], "index string, prefixes array<string>")
    rules = spark.createDataFrame([("user:", "account:"), ("user:admin:", "staff:")], "old string, new string")
    assert indexes.map_prefixes(d, rules, "app:").first().prefixes == ["app:account:", "app:staff:", "app:x:"]
    rules = spark.createDataFrame([("exact", 0, "client|kill", "kill", "check"), ("exact", 1, "eval", "lua", "check"), ("prefix", 2, "ts.", "series", "stop"), ("prefix", 3, "ts.add", "longer", "stop")], "kind string, position int, pattern string, title string, severity string")
    cmds = spark.createDataFrame([("s", "client|kill"), ("s", "client|list"), ("s", "eval"), ("s", "ts.add"), ("s", "ts.get")], "source string, command string")
    assert sorted((r.title, r.command) for r in assess.match_rules(cmds, rules, ["client"]).collect()) == [("kill", "client|kill"), ("lua", "eval"), ("series", "ts.add")]
    src = spark.createDataFrame([("s", "json", False, 0), ("s", "bloom", False, 0), ("s", "search", False, 0)], "source string, capability string, same_engine boolean, indexes int")
    gaps = assess.capability_gaps(src, spark.createDataFrame([("search",)], "capability string"))
    assert sorted(r.capability for r in gaps.collect()) == ["bloom", "json"]


def test_runs(spark):
    s = spark.createDataFrame([(1, 1, 406), (1, 2, 0), (1, 3, 0), (1, 4, 3), (1, 5, 2)], "run_id int, ts int, size int")
    assert [(r.previous, r.size) for r in runs.size_drops(s).collect()] == [(406, 0)]
    assert runs.size_drops(s, 0).count() == 0
    facts = spark.createDataFrame([(1, None, 0, 0, 0, 10, 5), (2, False, 9, 0, 0, 10, 5), (3, True, 0, 0, 0, 0, 0), (4, True, 0, 0, 2, 10, 5), (5, False, 5, 0, 0, 10, 5), (6, True, 0, 1, 0, 10, 5)], "run_id int, caught_up boolean, lag int, queued int, pending int, clean_since int, since int")
    assert {r.run_id: r.verdict for r in runs.cutover_verdict(facts).collect()} == {1: "LAGGING", 2: "LAGGING", 3: "NOT_SAFE", 4: "UNREVIEWED", 5: "SAFE", 6: "LAGGING"}


def test_record_sources(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("id\tname\n1\tWidget\n2\tGear\n")
    rows = readers.ingest_delimited(spark, str(tmp_path), "tsv", file_filter=r"a\.tsv")
    good, bad = readers.to_key_records(rows, "rec:${id}")
    assert sorted(r.key for r in good.collect()) == ["rec:1", "rec:2"] and bad.count() == 0
    broken = rows.withColumn("id", F.when(F.col("id") == 1, F.col("id")))
    assert readers.to_key_records(broken, "rec:${id}", file=F.lit("f"))[1].count() == 2
    snap = spark.createDataFrame([("s", 1, 10, "old"), ("s", 2, 20, "a")], "shard string, generation long, offset long, key string")
    ch = spark.createDataFrame([("s", 15, "b"), ("s", 25, "c")], "shard string, offset long, key string")
    assert sorted((r.key, r.seq) for r in readers.bootstrap_then_follow(snap, ch).collect()) == [("a", -1), ("c", 25)]


def test_field_ttls(spark):
    df = spark.createDataFrame([([("a", "1", 5500), ("b", "2", 100), ("c", "3", None)],)], "f array<struct<field: string, value: string, expire_at_ms: long>>")
    got = df.select(V.project_field_ttls(F.col("f"), F.lit(1000).cast("long")).alias("x")).first().x
    assert [(r.field, r.seconds) for r in got] == [("a", 5), ("c", None)]


def test_typed_envelope_of_odd_values(spark):
    cols = "key binary, type string, ttl_ms long, " + ", ".join(f"{n} {t}" for n, t in ST.VALUES.items())
    none = [None] * 5
    put = lambda kind, at, value: (kind.encode(), kind, None, *none[:at], value, *none[at + 1 :])
    rows = [
        put("string", 0, b"a\"b\n"), put("list", 1, [b"", b"\xff", b"x"]), put("hash", 2, [(b"f", None), (b"g", b"")]), put("zset", 3, [(b"m", float("-inf")), (b"n", 1.5)]),
        put("stream", 4, [("1-0", [(b"f", b"v")]), ("2-0", [])]), put("json", 0, b'{"a":[1,null]}'), (b"\xfe", "set", 5, *none),
    ]
    lines = [r.line for r in ST.to_typed_envelope(spark.createDataFrame(rows, cols)).collect()]
    assert sum('"base64":true' in line for line in lines) == 1 and sum("key_base64" in line for line in lines) == 1
    good, bad = ST.from_typed_envelope(spark.createDataFrame([(x,) for x in [*lines, "", "{", '{"key":"k","type":"list","value":"x"}', '{"type":"set","value":[]}']], "line string"))
    got = {r.type: r for r in good.collect()}
    assert got["string"].text == b"a\"b\n" and got["list"].members == [b"", b"\xff", b"x"] and got["json"].text == b'{"a":[1,null]}'
    assert [tuple(f) for f in got["hash"].fields] == [(b"f", b"null"), (b"g", b"")] and [tuple(m) for m in got["zset"].scored] == [(b"m", float("-inf")), (b"n", 1.5)]
    assert [(e.id, [tuple(f) for f in e.fields]) for e in got["stream"].entries] == [("1-0", [(b"f", b"v")]), ("2-0", [])]
    assert bytes(got["set"].key) == b"\xfe" and got["set"].members == [] and got["set"].ttl_ms == 5
    assert sorted(r.reason for r in bad.collect()) == ["no key", "not a JSON record", "not the value of a list"]


def test_stream_commands_without_entries(spark):
    cols = """key string, ttl_ms long, entries array<struct<id: string, fields: array<struct<field: string, value: string>>>>, last_id string,
      groups array<struct<name: string, last_delivered_id: string, entries_read: long, consumers: array<string>, pending: array<struct<id: string, consumer: string, delivered_at_ms: long, deliveries: long>>>>"""
    rows = [("a", None, None, "5-0", [("g", None, None, None, None), (None, "1-0", None, ["c"], None)]), ("b", 7, [], "5-0", None), ("c", -1, [("5-0", [("f", None)])], "5-0", [])]
    got = {}
    for r in ST.stream_commands(spark.createDataFrame(rows, cols)).orderBy("key", "seq").collect():
        got.setdefault(r.key, []).append(" ".join(r.argv))
    assert got == {"a": ["DEL a", "XGROUP CREATE a g 0 MKSTREAM", "XSETID a 5-0"], "b": ["DEL b", "PEXPIRE b 7"], "c": ["DEL c", "XADD c 5-0 f null"]}


def test_hash_chunks_merge(spark):
    cols = "key string, type string, chunk int, chunks int, fields array<struct<field: string, value: string, expire_at_ms: long>>"
    rows = [("k", "hash", 1, 2, [("a", "2", None), ("c", None, 9)]), ("k", "hash", 0, 2, [("a", "1", 5), ("b", "1", None)]), ("e", "hash", 0, 1, []), ("w", "hash", 0, 2, [("a", "1", None)])]
    done, waiting, failed = ST.join_hash_chunks(spark.createDataFrame(rows, cols))
    got = {r.key: [tuple(f) for f in r.fields] for r in done.collect()}
    assert got == {"k": [("a", "2", 5), ("b", "1", None), ("c", None, 9)], "e": []}
    assert [r.key for r in waiting.collect()] == ["w"] and failed.count() == 0


def test_answers_for_movable_commands(spark):
    log = spark.createDataFrame([("0", 1, 1, ["SORT", "a", "STORE", "b"]), ("0", 1, 2, ["EVAL", "x", "0"]), ("0", 1, 3, ["ODD", "z"]), ("0", 1, 4, ["SORT", "a", "STORE", "b"])], "shard string, generation long, offset_after long, argv array<string>")
    table = spark.createDataFrame([("sort", 1, 1, 1, True), ("eval", 0, 0, 0, True)], "name string, first int, last int, step int, movable boolean")
    answers = spark.createDataFrame([(["SORT", "a", "STORE", "b"], ["a", "b"]), (["SORT", "a", "STORE", "b"], ["a", "b"]), (["EVAL", "x", "0"], [])], "argv array<string>, keys array<string>")
    keys, open_ = sync.changed_keys(log, table, getkeys=answers)
    assert sorted(map(tuple, keys.collect())) == [("a", 4), ("b", 4)] and [r.offset_after for r in open_.collect()] == [3]
