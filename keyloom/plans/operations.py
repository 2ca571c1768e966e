"""More registered queries of the key-sync operators: typed values, deliveries, topology, runs, streams' batch forms, assessment."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.functions import keys, structured, values
from keyloom.operators import assess, indexes, modules, reconcile, runs, sync, topology
from keyloom.plans.queries import LISTS, LOG_SQL, SOURCE_KV, TARGET_KV, command_log, keyspaces, order_findings, order_lists
from keyloom.plans.queries import _t as table
from keyloom.plans.registry import query
from keyloom.session import ensure_checkpoint_dir
from keyloom.sources import readers, sinks


def shared_path(spark, kind: str) -> str:
    """A new path in the folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid.uuid4().hex}"


# ---- typed values and module types

MODULES = """CASE p_partkey % 8 WHEN 0 THEN 'ReJSON-RL' WHEN 1 THEN 'MBbloom--' WHEN 2 THEN 'vectorset' WHEN 3 THEN 'TopK-TYPE' WHEN 4 THEN 'hash' WHEN 5 THEN 'set' ELSE 'string' END"""


def parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Keys of core and module types; the target lacks some, and has other sizes, values or expiry for others."""
    k = F.col("p_partkey")
    names = ("ReJSON-RL", "MBbloom--", "vectorset", "TopK-TYPE", "hash", "set", "string", "string")
    kind = F.element_at(F.array(*map(F.lit, names)), (k % 8 + 1).cast("int"))
    ttl = F.when(k % 3 == 0, 60000).otherwise(-1).cast("long")
    rows = table(spark, sf, "part").select(k, F.concat(F.lit("part:"), k.cast("string")).alias("key"), kind.alias("type"), ttl.alias("ttl_ms"), F.col("p_size").cast("long").alias("size"), F.col("p_name").alias("value"))
    there = rows.filter(k % 5 != 0).withColumns({
        "ttl_ms": F.when(k % 7 == 0, F.col("ttl_ms") + 20000).otherwise(F.col("ttl_ms")), "size": F.when(k % 11 == 0, F.col("size") + 1).otherwise(F.col("size")),
        "value": F.when(k % 13 == 0, "other").otherwise(F.col("value")), "unreadable": k % 17 == 0, "key": F.concat(F.lit("new:"), "key"),
    })
    return rows.drop("p_partkey"), there.drop("p_partkey")


PARTS = f"""p AS (SELECT p_partkey AS k, 'part:' || CAST(p_partkey AS VARCHAR) AS key, {MODULES} AS type, p_partkey % 3 = 0 AS expires FROM part),
c AS (SELECT *, type IN ('hash', 'set', 'string') AS core, k % 5 <> 0 AS there FROM p WHERE type NOT IN ('vectorset', 'set')),
r AS (SELECT *, NOT there AND type = 'MBbloom--' AS not_restored, CASE WHEN NOT there AND type = 'MBbloom--' THEN NULL WHEN NOT there THEN 'missing_on_target'
 WHEN k % 7 = 0 THEN 'ttl' WHEN NOT core THEN NULL WHEN k % 11 = 0 THEN 'size' WHEN k % 17 = 0 THEN 'unreadable' WHEN k % 13 = 0 THEN 'value' END AS reason FROM c)"""


def compared_parts(spark, sf):
    src, tgt = parts(spark, sf)
    return reconcile.compare(src, tgt, keys.KeyNames.parse("", "new", ":"), types=["ReJSON-RL", "MBbloom--", "TopK-TYPE", "hash", "string", "vectorset"])


@query("reconcile_modules", f"WITH {PARTS} SELECT key, reason FROM r WHERE reason IS NOT NULL")
def reconcile_modules(spark, sf):
    return compared_parts(spark, sf).filter("reason is not null").select("key", "reason")


@query("reconcile_totals", f"WITH {PARTS} SELECT count(*) FILTER (NOT not_restored) AS keys_checked, count(reason) AS differences, count(*) FILTER (not_restored) AS not_restored FROM r")
def reconcile_totals(spark, sf):
    return reconcile.pass_totals(compared_parts(spark, sf))


def typed_lists(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Lists and sets of parts per order, in line order and in part order."""
    kind = F.when(F.col("l_orderkey") % 2 == 0, "set").otherwise("list").alias("type")
    line = table(spark, sf, "lineitem").groupBy("l_orderkey", kind)
    item = lambda *order: F.array_sort(F.collect_list(F.struct(*order)))["l_partkey"].cast("array<string>").alias("value")
    key, ttl = F.col("l_orderkey").cast("string").alias("key"), F.lit(-1).cast("long").alias("ttl_ms")
    return line.agg(item("l_linenumber", "l_partkey", "l_suppkey")).select(key, "type", ttl, "value"), line.agg(item("l_partkey")).select(key, "type", ttl, "value")


@query("validate_typed_values", f"""WITH l AS ({LISTS}), m AS (SELECT l_orderkey, list(l_partkey ORDER BY l_partkey) AS other FROM lineitem GROUP BY 1)
SELECT CAST(l_orderkey AS VARCHAR) AS key, CASE WHEN l_orderkey % 2 = 0 OR items = other THEN 'ok' ELSE 'value' END AS result FROM l JOIN m USING (l_orderkey)""")
def validate_typed_values(spark, sf):
    return sync.validate(*typed_lists(spark, sf))


@query("value_digests", f"""WITH l AS ({LISTS}), m AS (SELECT l_orderkey, list(l_partkey ORDER BY l_partkey) AS other FROM lineitem GROUP BY 1)
SELECT CAST(l_orderkey AS VARCHAR) AS key, (l_orderkey % 2 = 0 OR items = other) AS alike FROM l JOIN m USING (l_orderkey)""")
def value_digests(spark, sf):
    """Canonical digests of both sides: order counts in lists, not in sets."""
    a, b = ((df.select("key", values.digest(F.col("type"), F.col("value")).alias(n))) for df, n in zip(typed_lists(spark, sf), ("a", "b"), strict=True))
    return a.join(b, "key").select("key", (F.col("a") == F.col("b")).alias("alike"))


@query("carried_types", f"""WITH p AS (SELECT p_partkey AS k, {MODULES} AS type FROM part)
SELECT type, CASE type WHEN 'ReJSON-RL' THEN 'json_rebuild' WHEN 'vectorset' THEN 'not_supported' ELSE 'restore_only' END AS disposition,
 CASE type WHEN 'ReJSON-RL' THEN 'rebuilt from its text' WHEN 'vectorset' THEN 'no such type there' ELSE 'no rule for the type ' || type END AS reason, count(*) AS n FROM p GROUP BY 1, 2, 3""")
def carried_types(spark, sf):
    rules = spark.createDataFrame([("rejson-rl", "json_rebuild", "rebuilt from its text"), ("VECTORSET", "not_supported", "no such type there")], "type string, disposition string, reason string")
    return modules.dispositions(parts(spark, sf)[0].select("type"), rules).groupBy("type", "disposition", "reason").agg(F.count("*").alias("n"))


@query("fetched_values", f"""WITH p AS (SELECT p_partkey AS k, {MODULES} AS type FROM part)
SELECT CASE WHEN type NOT IN ('hash', 'set', 'string') THEN 'module' WHEN k % 5 = 0 THEN 'missing' WHEN k % 7 = 0 THEN 'failed' ELSE 'record' END AS route, count(*) AS n FROM p GROUP BY 1""")
def fetched_values(spark, sf):
    n = F.substring_index("key", ":", -1).cast("long")
    entries = parts(spark, sf)[0]
    v = entries.filter(n % 5 != 0).select("key", "value", F.when(n % 7 == 0, "cannot be read").alias("error"))
    routes = zip(("record", "missing", "module", "failed"), readers.fetch_values(entries.drop("value"), v), strict=True)
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("route"), "n") for name, df in routes]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


# ---- files


@query("delimited_ingest", """SELECT 'cust:' || CAST(c_custkey AS VARCHAR) AS key, 'hash' AS type, CAST(c_custkey AS VARCHAR) || '|' || c_name AS flat FROM customer""")
def delimited_ingest(spark, sf):
    """Customers as delimited files with a header, and back as hash records."""
    path = shared_path(spark, "tsv")
    table(spark, sf, "customer").select("c_custkey", "c_name").write.option("header", True).option("sep", "\t").csv(path)
    good, _ = readers.to_key_records(readers.ingest_delimited(spark, path, "tsv", file_filter=r"part-.*\.csv"), "cust:${c_custkey}", file=F.input_file_name())
    return good.select("key", "type", F.array_join(F.transform("value", lambda f: f["value"]), "|").alias("flat"))


@query("spoilt_files", """SELECT n_regionkey AS region, count(*) AS n, count(*) FILTER (n_nationkey % 7 = 3) > 0 AS failed FROM nation GROUP BY 1""")
def spoilt_files(spark, sf):
    """A record without a key spoils its whole file; a region's nations stand for a file."""
    rows = table(spark, sf, "nation").select("n_regionkey", F.when(F.col("n_nationkey") % 7 != 3, F.col("n_nationkey")).alias("id"))
    good, _ = readers.to_key_records(rows, "${id}", "json", file=F.col("n_regionkey"))
    region = F.get_json_object("value", "$.n_regionkey").cast("long")
    whole = good.groupBy(region.alias("region")).agg(F.count("*").alias("n")).withColumn("failed", F.lit(False))
    spoilt = rows.join(whole.select(F.col("region").alias("n_regionkey")), "n_regionkey", "left_anti").groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("n"))
    return whole.unionByName(spoilt.withColumn("failed", F.lit(True)))


@query("backup_roundtrip", f"""WITH p AS (SELECT 'part:' || CAST(p_partkey AS VARCHAR) AS key, {MODULES} AS type, CAST(CASE WHEN p_partkey % 3 = 0 THEN 60000 ELSE -1 END AS BIGINT) AS ttl_ms, p_name AS value FROM part)
SELECT key, type, ttl_ms, value, NULL AS reason FROM p WHERE type IN ('hash', 'set', 'string') UNION ALL SELECT key, NULL, NULL, NULL, 'a backup cannot hold ' || type FROM p WHERE type NOT IN ('hash', 'set', 'string')""")
def backup_roundtrip(spark, sf):
    """Records written as JSON lines and read again, and the ones a backup cannot hold."""
    path, text = shared_path(spark, "backup"), lambda c: F.decode(c, "UTF-8").alias(c)
    rows = parts(spark, sf)[0].select(F.encode("key", "UTF-8").alias("key"), "type", "ttl_ms", F.encode("value", "UTF-8").alias("value"))
    rejected = sinks.write_key_records(rows, path)
    good, _ = readers.read_key_records(spark, path)
    back = good.select(text("key"), "type", "ttl_ms", text("value"), F.lit(None).cast("string").alias("reason"))
    return back.unionByName(rejected.select(text("key"), "reason"), allowMissingColumns=True)


@query("reconcile_report", f"""WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}),
d AS (SELECT coalesce(s.key, t.key) AS key, CASE WHEN t.key IS NULL THEN 'missing_on_target' WHEN s.key IS NULL THEN 'extra_on_target' WHEN s.type <> t.type THEN 'type'
  WHEN (s.ttl_ms > 0) <> (t.ttl_ms > 0) OR (s.ttl_ms > 0 AND abs(s.ttl_ms - t.ttl_ms) > 5000) THEN 'ttl' WHEN s.size <> t.size THEN 'size' WHEN s.value <> t.value THEN 'value' END AS reason FROM s FULL JOIN t ON s.key = t.key),
f AS (SELECT key, reason FROM d WHERE reason IS NOT NULL), n AS (SELECT reason, count(*) AS n FROM f GROUP BY 1), e AS (SELECT key, reason FROM f ORDER BY key, reason LIMIT 100)
SELECT '# Reconcile pass (FULL)' AS line UNION ALL SELECT 'Trigger: by hand' UNION ALL SELECT CAST((SELECT count(*) FROM s) AS VARCHAR) || ' keys checked, ' || CAST((SELECT count(*) FROM f) AS VARCHAR) || ' differences'
UNION ALL SELECT '| reason | keys |' UNION ALL SELECT '|---|---|' UNION ALL SELECT '| ' || reason || ' | ' || CAST(n AS VARCHAR) || ' |' FROM n UNION ALL SELECT '- `' || key || '`: ' || reason FROM e""")
def reconcile_report(spark, sf):
    src, tgt = keyspaces(spark, sf)
    one = sinks.report(reconcile.first_differences(src, tgt), src.count(), "FULL", "by hand")
    path = shared_path(spark, "report")
    sinks.write_report(one, path, "md")
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("validation_file", f"WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}) SELECT s.key, CASE WHEN t.key IS NULL THEN 'missing' WHEN s.type <> t.type THEN 'type' ELSE 'ok' END AS result FROM s LEFT JOIN t ON s.key = t.key")
def validation_file(spark, sf):
    path = shared_path(spark, "validation")
    sinks.write_validation(sync.validate(*keyspaces(spark, sf), "TYPE"), path, "csv")
    return spark.read.option("header", True).csv(path)


# ---- applying


@query("deleted_by_event", f"WITH t AS ({TARGET_KV}) SELECT key FROM t WHERE key NOT IN (SELECT 'order:' || CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 4 = 0)")
def deleted_by_event(spark, sf):
    names = keys.KeyNames.parse("o:=order:")
    gone = table(spark, sf, "orders").filter("o_orderkey % 4 = 0").select(F.concat(F.lit("o:"), F.col("o_orderkey").cast("string")).alias("key"))
    return sync.apply_deletes(gone, keyspaces(spark, sf)[1], names)[0].select("key")


@query("hooked_records", f"WITH s AS ({SOURCE_KV}) SELECT key, type, CASE WHEN size = 7 THEN 'too large' END AS reason, upper(value) AS value FROM s WHERE type <> 'list'")
def hooked_records(spark, sf):
    hook = lambda r: r.filter("type <> 'list'").withColumns({"value": F.upper("value"), "reason": F.when(F.col("size") == 7, "too large")})
    return sync.with_hook(keyspaces(spark, sf)[0], hook).select("key", "type", "reason", "value")


@query("routed_failures", f"WITH s AS ({SOURCE_KV}) SELECT size = 7 AS failed, count(*) AS n FROM s GROUP BY 1")
def routed_failures(spark, sf):
    good, bad = sync.route(hooked_all(spark, sf))
    n = lambda df, failed: df.agg(F.count("*").alias("n")).select(F.lit(failed).alias("failed"), "n")
    return n(good, False).unionByName(n(bad, True))


def hooked_all(spark, sf):
    return sync.with_hook(keyspaces(spark, sf)[0], lambda r: r.withColumn("reason", F.when(F.col("size") == 7, "too large")))


@query("until_clean", "SELECT CAST(2 AS INTEGER) AS passes, CAST(0 AS BIGINT) AS differences, count(*) AS keys FROM orders")
def until_clean(spark, sf):
    from keyloom.session import checkpointed

    target, passes, left = sync.reconcile_until_clean(*keyspaces(spark, sf), settle=checkpointed)
    return target.agg(F.count("*").alias("keys")).select(F.lit(passes).alias("passes"), F.lit(left).cast("long").alias("differences"), "keys")


@query("dead_letters_again", """WITH f AS (SELECT user_id AS key, ts, event_id, event_type AS reason, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type IN ('error', 'click'))
SELECT CAST(key AS VARCHAR) AS key, max(CASE WHEN rn = 1 THEN reason END) AS reason, CAST(least(count(*) - 1, 5) AS BIGINT) AS n_history, coalesce(string_agg(reason, ',' ORDER BY rn) FILTER (rn BETWEEN 2 AND 6), '') AS history FROM f GROUP BY key""")
def dead_letters_again(spark, sf):
    """Failures of the later half of the events meet the records that those of the earlier half have left."""
    e = table(spark, sf, "events").filter("event_type in ('error', 'click')")
    f = e.select(F.col("user_id").cast("string").alias("key"), F.lit(0).alias("chunk"), F.col("event_type").alias("reason"), F.col("ts").alias("failed_at"), F.col("event_id").alias("seq"))
    middle = e.agg(F.percentile_approx("ts", 0.5).alias("m")).first()["m"]
    first = sync.dead_letters(f.filter(F.col("failed_at") < F.lit(middle)), 5)
    d = sync.dead_letters(f.filter(F.col("failed_at") >= F.lit(middle)), 5, first)
    return d.select("key", "reason", F.size("history").cast("long").alias("n_history"), F.array_join(F.transform("history", lambda h: h["reason"]), ",").alias("history"))


@query("pending_letters", "SELECT count(DISTINCT user_id) AS pending FROM events WHERE event_type = 'error'")
def pending_letters(spark, sf):
    e = table(spark, sf, "events").filter("event_type = 'error'")
    return sync.pending(sync.dead_letters(e.select(F.col("user_id").cast("string").alias("key"), F.lit(0).alias("chunk"), F.col("event_type").alias("reason"), F.col("ts").alias("failed_at"), F.col("event_id").alias("seq"))))


@query("field_ttls", """SELECT o_orderkey AS key, CASE WHEN o_orderkey % 4 = 0 THEN CAST(1 + o_orderkey % 50 AS BIGINT) END AS seconds, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS fields FROM orders""")
def field_ttls(spark, sf):
    k = F.col("o_orderkey")
    field = lambda name, at: F.struct(F.lit(name).alias("field"), F.lit("v").alias("value"), at.cast("long").alias("expire_at_ms"))
    rows = table(spark, sf, "orders").select(k.alias("key"), F.array(
        field("a", F.when(k % 4 == 0, 100_000 + (k % 50) * 1000 + 1)), field("b", F.when(k % 3 == 0, 99_999)),
    ).alias("fields"))
    out = rows.withColumn("f", values.project_field_ttls(F.col("fields"), F.lit(100_000).cast("long")))
    return out.select("key", F.col("f")[0]["seconds"].alias("seconds"), F.size("f").alias("fields"))


# ---- topology and runs


@query("topology_change", """WITH e AS (SELECT event_type = 'view' AS now, user_id % 40 AS node_id, user_id // 40 AS slot FROM events WHERE (event_type = 'view' AND user_id % 40 < 35) OR (event_type = 'click' AND user_id % 40 > 4 AND event_id % 3 = 0)),
b AS (SELECT node_id, list(DISTINCT slot ORDER BY slot) AS s FROM e WHERE NOT now GROUP BY 1), c AS (SELECT node_id, list(DISTINCT slot ORDER BY slot) AS s FROM e WHERE now GROUP BY 1)
SELECT coalesce(b.node_id, c.node_id) AS node_id, CASE WHEN b.s IS NULL THEN 'joined' WHEN c.s IS NULL THEN 'departed' ELSE 'reassigned' END AS change FROM b FULL JOIN c ON b.node_id = c.node_id WHERE b.s IS NULL OR c.s IS NULL OR b.s <> c.s""")
def topology_change(spark, sf):
    e = table(spark, sf, "events").select((F.col("user_id") % 40).alias("node_id"), F.floor(F.col("user_id") / 40).alias("slot"), "event_type", "event_id")
    return topology.topology_diff(e.filter("event_type = 'click' and node_id > 4 and event_id % 3 = 0").select("node_id", "slot"), e.filter("event_type = 'view' and node_id < 35").select("node_id", "slot"))


@query("resumed_positions", """WITH p AS (SELECT user_id AS repl_id, max(event_id) AS "offset", count(*) % 2 = 0 AS active FROM events GROUP BY 1), s AS (SELECT s_suppkey AS shard, unnest([s_suppkey % 170, s_suppkey % 150]) AS repl_id FROM supplier),
m AS (SELECT shard, p.repl_id, "offset", row_number() OVER (PARTITION BY shard ORDER BY active, "offset" DESC) AS rn FROM s JOIN p USING (repl_id)) SELECT s_suppkey AS shard, "offset" FROM supplier LEFT JOIN m ON shard = s_suppkey AND rn = 1""")
def resumed_positions(spark, sf):
    pos = table(spark, sf, "events").groupBy(F.col("user_id").alias("repl_id")).agg(F.max("event_id").alias("offset"), (F.count("*") % 2 == 0).alias("active"))
    k = F.col("s_suppkey")
    return topology.resume_positions(table(spark, sf, "supplier").select(k.alias("shard"), F.array_distinct(F.array(k % 170, k % 150)).alias("repl_ids")), pos).select("shard", "offset")


@query("slot_health", """WITH n AS (SELECT * FROM nation WHERE n_nationkey % 5 <> 4), c AS (SELECT DISTINCT s.range AS slot FROM n, range(16384) s WHERE s.range BETWEEN n_nationkey * 600 AND n_nationkey * 600 + 599)
SELECT 'failed' AS status, CAST(16384 - count(*) AS VARCHAR) || ' slots uncovered' AS reason FROM c""")
def slot_health(spark, sf):
    n = F.col("n_nationkey")
    nodes = table(spark, sf, "nation").filter(n % 5 != 4).select(n.alias("node_id"), F.lit("master").alias("role"), F.lit(False).alias("failed"), F.lit(False).alias("migrating"), (n * 600).alias("start"), (n * 600 + 599).alias("end"))
    return topology.slot_health(nodes)


@query("keyspace_sizes", "SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'source' ELSE 'target' END AS side, CAST(sum(s_nationkey) AS BIGINT) AS keys FROM supplier GROUP BY 1")
def keyspace_sizes(spark, sf):
    side = F.when(F.col("s_suppkey") % 2 == 0, "source").otherwise("target")
    return topology.db_size(table(spark, sf, "supplier").select(side.alias("side"), F.col("s_nationkey").cast("long").alias("keys")))


@query("moved_database", "SELECT event_id, 5 AS db FROM events WHERE user_id % 3 = 1")
def moved_database(spark, sf):
    return sync.remap_db(table(spark, sf, "events").select("event_id", (F.col("user_id") % 3).alias("db")), 1, 5)


@query("filtered_event_types", "SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 'wanted' ELSE 'filtered' END AS route FROM events")
def filtered_event_types(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.concat(F.lit("__keyspace@0__:user:"), F.col("user_id").cast("string")).alias("channel"), F.col("event_type").alias("message"))
    out = sync.route_events(e, types=["ERROR", "View"])
    return out.select("event_id", F.when(F.col("route") == "filtered", "filtered").otherwise("wanted").alias("route"))


@query("passes_due", """WITH s AS (SELECT user_id % 10 AS run_id, date_trunc('day', ts) AS ts, count(*) AS size FROM events GROUP BY 1, 2), p AS (SELECT *, lag(size) OVER (PARTITION BY run_id ORDER BY ts) AS previous FROM s)
SELECT DISTINCT run_id, 'a size drop from ' || CAST(previous AS VARCHAR) || ' to ' || CAST(size AS VARCHAR) AS trigger FROM p WHERE previous > 0 AND size <= previous * 50 // 100 UNION SELECT DISTINCT user_id % 10, 'a flush' FROM events WHERE event_type = 'signup' AND user_id % 10 < 4""")
def passes_due(spark, sf):
    e = table(spark, sf, "events").withColumn("run_id", F.col("user_id") % 10)
    samples = e.groupBy("run_id", F.date_trunc("day", "ts").alias("ts")).agg(F.count("*").alias("size"))
    return runs.reconcile_due(samples, e.filter("event_type = 'signup' and run_id < 4").select("run_id"), 50)


@query("run_totals", """SELECT user_id % 7 AS run_id, count(*) AS scanned, count(*) FILTER (event_type = 'view') AS success, count(*) FILTER (event_type = 'click') AS skipped, count(*) FILTER (event_type = 'error') AS failure, count(*) FILTER (event_type = 'signup') AS dead_letter FROM events GROUP BY 1""")
def run_totals(spark, sf):
    names = {"view": "success", "click": "skipped", "error": "failure", "signup": "dead_letter"}
    outcome = F.element_at(F.create_map(*(F.lit(x) for p in names.items() for x in p)), F.col("event_type"))
    return runs.run_summary(table(spark, sf, "events").select((F.col("user_id") % 7).alias("run_id"), outcome.alias("outcome")))


@query("clean_passes", """SELECT o_custkey AS run_id, CAST(max_by(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey ELSE 0 END, o_orderkey) AS BIGINT) AS clean_since FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1""")
def clean_passes(spark, sf):
    k = F.col("o_orderkey")
    passes = table(spark, sf, "orders").select(F.col("o_custkey").alias("run_id"), F.when(k % 2 == 0, "FULL").otherwise("SAMPLE").alias("mode"), k.alias("started_at"), k.alias("finished_at"), F.when(k % 3 == 0, 5).otherwise(0).alias("differences"))
    return runs.clean_since(passes)


# ---- logs


@query("resumed_log", "SELECT event_id AS offset_after FROM events WHERE event_id > 2000 * (user_id % 3) OR user_id % 3 = 2")
def resumed_log(spark, sf):
    """A command log read behind the positions that two of its three shards have saved."""
    path = shared_path(spark, "log")
    log = table(spark, sf, "events").select((F.col("user_id") % 3).cast("string").alias("shard"), F.lit(1).cast("long").alias("generation"), F.col("event_id").alias("offset_after"), F.array(F.lit("SET"), F.lit("k")).alias("argv"))
    log.write.parquet(path)
    at = spark.createDataFrame([("0", 0), ("1", 2000)], "shard string, offset long")
    return readers.read_command_log(spark, path, at).select("offset_after")


@query("bootstrap_order", """WITH s AS (SELECT user_id % 3 AS shard, 1 + user_id % 2 AS generation, 1000 * (1 + user_id % 2) AS "offset", user_id AS key FROM events WHERE event_id < 5000),
n AS (SELECT shard, max(generation) AS g, max_by("offset", generation) AS o FROM s GROUP BY 1)
SELECT s.shard, s.key, CAST(-1 AS BIGINT) AS seq FROM s JOIN n ON s.shard = n.shard AND generation = g UNION ALL SELECT user_id % 3, user_id, event_id FROM events LEFT JOIN n ON n.shard = user_id % 3 WHERE o IS NULL OR event_id > o""")
def bootstrap_order(spark, sf):
    e, u = table(spark, sf, "events"), F.col("user_id")
    snapshot = e.filter("event_id < 5000").select((u % 3).alias("shard"), (u % 2 + 1).alias("generation"), ((u % 2 + 1) * 1000).alias("offset"), u.alias("key"))
    return readers.bootstrap_then_follow(snapshot, e.select((u % 3).alias("shard"), F.col("event_id").alias("offset"), u.alias("key")))


@query("chunks_again", f"WITH l AS ({LISTS}) SELECT CAST(l_orderkey AS VARCHAR) AS key, array_to_string(items, ',') AS items FROM l")
def chunks_again(spark, sf):
    """Chunks that arrive twice, the second time with other items: the first ones count."""
    c = values.split_chunks(order_lists(spark, sf), "items", {"list": 3}).withColumn("seq", F.lit(1))
    late = c.withColumns({"items": F.transform("items", lambda x: F.lit("0")), "seq": F.lit(2)})
    done, _, _ = values.join_chunks(late.unionByName(c), "items", order=["seq"])
    return done.select("key", F.array_join("items", ",").alias("items"))


@query("late_chunks", f"""WITH l AS ({LISTS}), c AS (SELECT l_orderkey, CAST(ceil(len(items) / 3.0) AS BIGINT) AS n FROM l WHERE len(items) > 3)
SELECT CAST(l_orderkey AS VARCHAR) AS key, 'only ' || CAST(n - 1 AS VARCHAR) || ' of the key''s ' || CAST(n AS VARCHAR) || ' chunks arrived' AS reason FROM c""")
def late_chunks(spark, sf):
    c = values.split_chunks(order_lists(spark, sf), "items", {"list": 3}).filter("chunks > 1 and chunk > 0")
    return values.join_chunks(c, "items", waits=10)[2]


# ---- assessment


@query("matched_rules", """WITH c AS (SELECT DISTINCT l_suppkey % 20 AS source, CASE l_partkey % 5 WHEN 0 THEN 'client|kill' WHEN 1 THEN 'client|list' WHEN 2 THEN 'eval' WHEN 3 THEN 'ts.add' ELSE 'config|set' END AS command FROM lineitem WHERE (l_suppkey + l_partkey) % 11 < 6)
SELECT source, CASE command WHEN 'client|kill' THEN 'kill' WHEN 'eval' THEN 'lua' WHEN 'config|set' THEN 'configuration' ELSE 'series' END AS title, CASE command WHEN 'ts.add' THEN 'stop' ELSE 'check' END AS severity, command FROM c WHERE command <> 'client|list'""")
def matched_rules(spark, sf):
    name = F.element_at(F.array(*map(F.lit, ("client|kill", "client|list", "eval", "ts.add", "config|set"))), (F.col("l_partkey") % 5 + 1).cast("int"))
    used = table(spark, sf, "lineitem").filter("(l_suppkey + l_partkey) % 11 < 6").select((F.col("l_suppkey") % 20).alias("source"), name.alias("command")).distinct()
    return assess.match_rules(used, command_rules(spark), ["client"])


def command_rules(spark):
    rows = [("exact", 1, "client|kill", "kill", "check"), ("exact", 2, "eval", "lua", "check"), ("exact", 3, "config", "configuration", "check"), ("prefix", 4, "ts.", "series", "stop"), ("prefix", 5, "ts.a", "never first", "info")]
    return spark.createDataFrame(rows, "kind string, position int, pattern string, title string, severity string")


@query("capability_gaps", """WITH c AS (SELECT s_suppkey AS source, CASE s_suppkey % 4 WHEN 0 THEN 'json' WHEN 1 THEN 'bloom' WHEN 2 THEN 'search' ELSE 'streams' END AS capability, s_suppkey % 3 = 0 AS same_engine, s_suppkey % 5 AS indexes FROM supplier)
SELECT source, capability, CASE capability WHEN 'bloom' THEN 'moves only between sides of the same engine' ELSE 'the target lacks it' END AS reason FROM c
WHERE (capability = 'bloom' AND NOT same_engine) OR capability = 'json' OR (capability = 'search' AND indexes > 0)""")
def capability_gaps(spark, sf):
    k = F.col("s_suppkey")
    name = F.element_at(F.array(*map(F.lit, ("json", "bloom", "search", "streams"))), (k % 4 + 1).cast("int"))
    src = table(spark, sf, "supplier").select(k.alias("source"), name.alias("capability"), (k % 3 == 0).alias("same_engine"), (k % 5).alias("indexes"))
    return assess.capability_gaps(src, spark.createDataFrame([("streams",)], "capability string"))


@query("copy_routes", f"""WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}), one AS (SELECT type, CAST(size % 2 AS VARCHAR) AS encoding, min(key) AS key FROM s GROUP BY 1, 2),
v AS (SELECT one.type, encoding FROM one JOIN s ON s.key = one.key JOIN t ON t.key = one.key WHERE t.value = s.value)
SELECT s.key, CASE WHEN v.type IS NULL THEN 'typed' ELSE 'fast' END AS route FROM s LEFT JOIN v ON s.type = v.type AND CAST(s.size % 2 AS VARCHAR) = v.encoding""")
def copy_routes(spark, sf):
    src, tgt = keyspaces(spark, sf)
    s = src.select("key", "type", (F.col("size") % 2).cast("string").alias("encoding"), F.col("value").alias("digest"))
    verdicts = modules.restore_verdicts(s, tgt.select("key", F.col("value").alias("digest"), F.lit(None).cast("string").alias("error")))
    return modules.route_by_verdict(s, verdicts).select("key", "route")


@query("waiting_streams", """WITH g AS (SELECT user_id, event_type, count(*) FILTER (event_id % 200 = 0) AS pending FROM events GROUP BY 1, 2)
SELECT count(DISTINCT user_id) FILTER (pending > 0) AS streams, count(*) FILTER (pending > 0) AS groups FROM g""")
def waiting_streams(spark, sf):
    g = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count_if(F.col("event_id") % 200 == 0).cast("int").alias("pending"))
    return assess.pending_streams(g.groupBy(F.col("user_id").alias("key")).agg(F.collect_list(F.struct(F.col("event_type").alias("name"), "pending")).alias("groups")))


@query("ranked_findings", """SELECT o_custkey AS source, CASE o_orderpriority WHEN '1-URGENT' THEN 'stop' WHEN '2-HIGH' THEN 'action' WHEN '3-MEDIUM' THEN 'check' ELSE 'info' END AS severity, o_comment_free AS title FROM (SELECT *, 'order ' || CAST(o_orderkey AS VARCHAR) AS o_comment_free FROM orders)""")
def ranked_findings(spark, sf):
    f = order_findings(spark, sf, title=F.concat(F.lit("order "), F.col("o_orderkey").cast("string")))
    return assess.sorted_findings(f).select("source", "severity", "title")


@query("assessment", """WITH f AS (SELECT s_suppkey AS source, s_suppkey % 10 AS used, 8 AS target_max, s_suppkey % 4 AS target_keys, s_suppkey % 6 = 0 AS managed, s_suppkey % 2 = 0 AS notified, s_suppkey % 5 = 0 AS clustered FROM supplier),
c AS (SELECT DISTINCT l_suppkey AS source, CASE l_partkey % 3 WHEN 0 THEN 'eval' WHEN 1 THEN 'ts.add' ELSE 'get' END AS command FROM lineitem)
SELECT source, 'stop' AS severity, 'the data does not fit the target' AS title FROM f WHERE used > target_max UNION ALL SELECT source, 'check', 'the target already holds keys' FROM f WHERE target_keys > 0
UNION ALL SELECT source, 'check', 'managed source: some commands may be closed' FROM f WHERE managed UNION ALL SELECT source, 'action', 'keyspace notifications are off' FROM f WHERE NOT notified
UNION ALL SELECT source, 'check', 'cluster source: copy every master' FROM f WHERE clustered UNION ALL SELECT source, 'stop', 'no vectors there' FROM f WHERE source % 3 = 0
UNION ALL SELECT source, 'check', '1 users with key or channel patterns' FROM f WHERE source % 7 = 0 UNION ALL SELECT source, CASE command WHEN 'eval' THEN 'check' ELSE 'stop' END, CASE command WHEN 'eval' THEN 'lua' ELSE 'series' END FROM c WHERE command <> 'get'
UNION ALL SELECT source, 'check', 'the target lacks ts.add' FROM c WHERE command = 'ts.add'""")
def assessment(spark, sf):
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier")
    facts = s.select(
        k.alias("source"), (k % 10).alias("used"), F.lit(8).alias("target_max"), (k % 4).alias("target_keys"), (k % 6 == 0).alias("managed"),
        F.when(k % 2 == 0, "KEA").alias("notify"), F.when(k % 5 == 0, "cluster").otherwise("single").alias("mode"), F.lit(False).alias("aof"),
    )
    name = F.element_at(F.array(*map(F.lit, ("eval", "ts.add", "get"))), (F.col("l_partkey") % 3 + 1).cast("int"))
    used = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("source"), name.alias("command")).distinct()
    types = s.filter(k % 3 == 0).select(k.alias("source"), F.lit("VectorSet").alias("type"), F.lit(1).alias("n"))
    acls = s.select(k.alias("source"), F.lit("u").alias("user"), F.when(k % 7 == 0, "on ~app:* +@all").otherwise("on ~* +@all").alias("rule"))
    type_rules = spark.createDataFrame([("vectorset", "stop", "no vectors there")], "type string, severity string, title string")
    return assess.assess(facts, used, types, acls, command_rules(spark), type_rules, spark.createDataFrame([("get",), ("eval",)], "command string"), ["client"])


@query("suggested_tools", """WITH r AS (SELECT o_custkey AS source, CASE o_orderkey % 3 WHEN 0 THEN 'copy' WHEN 1 THEN 'stream' ELSE 'dump' END AS tool, CAST(o_orderkey % 5 - 1 AS BIGINT) AS weight FROM orders),
t AS (SELECT source, tool, CAST(sum(weight) AS BIGINT) AS score, count(*) AS reasons FROM r GROUP BY 1, 2) SELECT source, tool, score, reasons FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, tool) AS rn FROM t) WHERE rn = 1""")
def suggested_tools(spark, sf):
    k = F.col("o_orderkey")
    tool = F.element_at(F.array(*map(F.lit, ("copy", "stream", "dump"))), (k % 3 + 1).cast("int"))
    reasons = table(spark, sf, "orders").select(F.col("o_custkey").alias("source"), tool.alias("tool"), (k % 5 - 1).alias("weight"), F.concat(F.lit("order "), k.cast("string")).alias("reason"))
    return assess.suggest(reasons).select("source", "tool", "score", F.size("reasons").cast("long").alias("reasons"))


@query("index_arguments", """WITH p AS (SELECT p_brand AS "index", p_partkey, p_name, CASE WHEN p_size < 20 THEN 'TAG' WHEN p_size < 30 THEN 'NUMERIC' END AS kind FROM part)
SELECT "index", coalesce(string_agg(p_name || ' AS f' || CAST(p_partkey AS VARCHAR) || ' ' || kind, ' ' ORDER BY p_partkey) FILTER (kind IS NOT NULL), '') AS args, count(kind) > 0 AS supported FROM p GROUP BY 1""")
def index_arguments(spark, sf):
    kind = F.when(F.col("p_size") < 20, "tag").when(F.col("p_size") < 30, "Numeric").otherwise("odd")
    fields = table(spark, sf, "part").select(F.col("p_brand").alias("index"), F.col("p_partkey").alias("position"), F.col("p_name").alias("identifier"), F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("attribute"), kind.alias("kind"), F.array().cast("array<string>").alias("options"))
    return indexes.index_args(fields).select("index", F.array_join("args", " ").alias("args"), "supported")


@query("index_prefixes", """WITH d AS (SELECT p_brand AS "index", 'p:' || p_brand || ':' AS prefix FROM part GROUP BY 1 UNION ALL SELECT p_brand, 'x:' FROM part GROUP BY 1)
SELECT "index", string_agg(CASE WHEN prefix = 'x:' THEN 'new:x:,new:deep:' WHEN prefix = 'p:Brand#11:' THEN 'new:one:' ELSE 'new:q:' || substr(prefix, 3) END, ',' ORDER BY CASE WHEN prefix = 'x:' THEN 1 ELSE 0 END) AS prefixes FROM d GROUP BY 1""")
def index_prefixes(spark, sf):
    """Prefixes under their new names, and those of the rules below them."""
    d = table(spark, sf, "part").select(F.col("p_brand").alias("index")).distinct()
    d = d.withColumn("prefixes", F.array(F.concat(F.lit("p:"), "index", F.lit(":")), F.lit("x:")))
    rules = spark.createDataFrame([("p:", "q:"), ("p:Brand#11:", "one:"), ("x:y:", "deep:")], "old string, new string")
    return indexes.map_prefixes(d, rules, "new:").select("index", F.array_join("prefixes", ",").alias("prefixes"))


# ---- values with structure


@query("resolved_commands", f"""WITH {LOG_SQL}, k AS (SELECT event_id, 'user:' || CAST(user_id AS VARCHAR) AS key FROM l WHERE db = 0 AND (event_type IN ('view', 'click') OR event_type = 'signup' AND user_id % 3 = 0)
 UNION ALL SELECT event_id, 'user:' || CAST(user_id AS VARCHAR) || ':b' FROM l WHERE db = 0 AND event_type = 'click'), o AS (SELECT event_id FROM l WHERE db = 0 AND event_type = 'signup' AND user_id % 3 = 1)
SELECT key, max(event_id) AS "offset" FROM k GROUP BY key UNION ALL SELECT NULL, event_id FROM o""")
def resolved_commands(spark, sf):
    """Keys of commands that a server's answers resolve, and the offsets of those without an answer."""
    log, commands = command_log(spark, sf)
    key = F.get("argv", F.lit(1))
    n = F.substring_index(key, ":", -1).cast("long") % 3
    asked = log.filter(F.get("argv", F.lit(0)) == "XTHING").select("argv", F.when(n == 0, F.array(key)).when(n == 2, F.array().cast("array<string>")).alias("keys"))
    changed, unresolved = sync.changed_keys(log, commands, getkeys=asked.filter("keys is not null"))
    return changed.unionByName(unresolved.select(F.lit(None).cast("string").alias("key"), F.col("offset_after").alias("offset")))


@query("stream_commands", """WITH e AS (SELECT user_id AS u, event_id AS id, event_type AS t, 's:' || CAST(user_id AS VARCHAR) AS k FROM events), u AS (SELECT u, k, min(id) AS lo, max(id) AS hi FROM e GROUP BY 1, 2),
c AS (SELECT k, 0 AS stage, 0 AS pos, 'DEL ' || k AS line FROM u UNION ALL SELECT k, 1, id, 'XADD ' || k || ' ' || CAST(id AS VARCHAR) || '-0 type ' || t FROM e
 UNION ALL SELECT k, 2, 0, 'XGROUP CREATE ' || k || ' g 0 MKSTREAM' FROM u WHERE u % 2 = 0 UNION ALL SELECT k, 2, 1, 'XGROUP SETID ' || k || ' g 0 ENTRIESREAD ' || CAST(u AS VARCHAR) FROM u WHERE u % 4 = 0
 UNION ALL SELECT k, 3, 0, 'XSETID ' || k || ' ' || CAST(hi + 1 AS VARCHAR) || '-0' FROM u WHERE u % 3 = 0 UNION ALL SELECT k, 4, 0, 'XGROUP CREATECONSUMER ' || k || ' g c' FROM u WHERE u % 2 = 0
 UNION ALL SELECT k, 5, 0, 'XCLAIM ' || k || ' g c 0 ' || CAST(lo AS VARCHAR) || '-0 TIME 1000 RETRYCOUNT 2 FORCE JUSTID' FROM u WHERE u % 2 = 0 UNION ALL SELECT k, 6, 0, 'PEXPIRE ' || k || ' 60000' FROM u WHERE u % 5 = 0)
SELECT k AS key, CAST(row_number() OVER (PARTITION BY k ORDER BY stage, pos) - 1 AS INTEGER) AS seq, line FROM c""")
def stream_commands(spark, sf):
    """Each user's events as a stream, some with a group, a pending entry and a later last id."""
    u, text = F.col("user_id"), lambda c: F.concat(c.cast("string"), F.lit("-0"))
    fields = F.array(F.struct(F.lit("type").alias("field"), F.col("event_type").alias("value")))
    entry = F.struct("event_id", fields.alias("fields"))
    streams = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("e"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    pending = F.struct(text(F.col("lo")).alias("id"), F.lit("c").alias("consumer"), F.lit(1000).cast("long").alias("delivered_at_ms"), F.lit(2).cast("long").alias("deliveries"))
    group = F.struct(
        F.lit("g").alias("name"), F.lit("0").alias("last_delivered_id"), F.when(u % 4 == 0, u).alias("entries_read"), F.array(F.lit("c")).alias("consumers"), F.array(pending).alias("pending")
    )
    records = streams.select(
        F.concat(F.lit("s:"), u.cast("string")).alias("key"), F.when(u % 5 == 0, 60000).otherwise(-1).cast("long").alias("ttl_ms"),
        F.transform("e", lambda e: F.struct(text(e["event_id"]).alias("id"), e["fields"].alias("fields"))).alias("entries"),
        text(F.col("hi") + F.when(u % 3 == 0, 1).otherwise(0)).alias("last_id"), F.when(u % 2 == 0, F.array(group)).alias("groups"),
    )
    return structured.stream_commands(records).select("key", "seq", F.array_join("argv", " ").alias("line"))


@query("document_commands", """SELECT 'd:' || CAST(p_partkey AS VARCHAR) AS key, 0 AS seq, 'JSON.SET d:' || CAST(p_partkey AS VARCHAR) || ' . {"size":' || CAST(p_size AS VARCHAR) || '}' AS line FROM part
UNION ALL SELECT 'd:' || CAST(p_partkey AS VARCHAR), 1, 'PEXPIRE d:' || CAST(p_partkey AS VARCHAR) || ' 5000' FROM part WHERE p_size % 2 = 0""")
def document_commands(spark, sf):
    key = F.concat(F.lit("d:"), F.col("p_partkey").cast("string")).alias("key")
    records = table(spark, sf, "part").select(key, F.when(F.col("p_size") % 2 == 0, 5000).otherwise(-1).cast("long").alias("ttl_ms"), F.to_json(F.struct(F.col("p_size").alias("size"))).alias("document"))
    return structured.document_commands(records).select("key", "seq", F.array_join("argv", " ").alias("line"))


TYPED = "CASE o_custkey % 5 WHEN 0 THEN 'list' WHEN 1 THEN 'hash' WHEN 2 THEN 'zset' WHEN 3 THEN 'stream' ELSE 'string' END"


@query("typed_envelopes", f"""WITH o AS (SELECT o_custkey AS c, {TYPED} AS type, o_orderkey AS o, o_orderstatus AS v, o_totalprice AS p, CASE WHEN o_custkey % 7 = 0 THEN 'FF' ELSE '' END AS head FROM orders),
f AS (SELECT c, type, o, CASE type WHEN 'list' THEN head || hex(encode(CAST(o AS VARCHAR))) WHEN 'hash' THEN hex(encode(CAST(o AS VARCHAR))) || '=' || head || hex(encode(v))
 WHEN 'zset' THEN head || hex(encode(CAST(o AS VARCHAR))) || '=' || CASE WHEN o % 3 = 0 THEN 'up' ELSE CAST(CAST(floor(p) AS BIGINT) AS VARCHAR) END WHEN 'stream' THEN hex(encode(CAST(o AS VARCHAR) || '-0')) || ':' || hex(encode('s')) || '=' || head || hex(encode(v)) END AS one, head FROM o)
SELECT 'c:' || CAST(c AS VARCHAR) AS key, type, CAST(c AS BIGINT) AS ttl_ms, CASE WHEN type = 'string' THEN min(head) || hex(encode(CAST(count(*) AS VARCHAR))) ELSE string_agg(one, ',' ORDER BY o) END AS flat FROM f GROUP BY c, type""")
def typed_envelopes(spark, sf):
    """Each customer's orders as a value of one of five types, to JSON lines and back; some hold bytes that are no text."""
    raw = lambda c: F.encode(c.cast("string"), "UTF-8")
    kind = F.element_at(F.array(*map(F.lit, ("list", "hash", "zset", "stream", "string"))), (F.col("c") % 5 + 1).cast("int"))
    grouped = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_totalprice"))).alias("l"))
    head = F.when(F.col("c") % 7 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    spoilt = lambda c: F.concat(F.col("head"), raw(c))
    pair = lambda field, value: F.struct(field.alias("field"), value.alias("value"))
    score = lambda o: F.when(o["o_orderkey"] % 3 == 0, float("inf")).otherwise(F.floor(o["o_totalprice"]).cast("double")).alias("score")
    of = lambda name, one: F.when(kind == name, F.transform("l", one))
    records = grouped.withColumn("head", head).select(
        raw(F.concat(F.lit("c:"), F.col("c").cast("string"))).alias("key"), kind.alias("type"), F.col("c").cast("long").alias("ttl_ms"), F.when(kind == "string", spoilt(F.size("l"))).alias("text"),
        of("list", lambda o: spoilt(o["o_orderkey"])).alias("members"), of("hash", lambda o: pair(raw(o["o_orderkey"]), spoilt(o["o_orderstatus"]))).alias("fields"),
        of("zset", lambda o: F.struct(spoilt(o["o_orderkey"]).alias("member"), score(o))).alias("scored"),
        of("stream", lambda o: F.struct(F.concat(o["o_orderkey"].cast("string"), F.lit("-0")).alias("id"), F.array(pair(raw(F.lit("s")), spoilt(o["o_orderstatus"]))).alias("fields"))).alias("entries"),
    )
    path = shared_path(spark, "typed")
    structured.to_typed_envelope(records).write.text(path)
    good, _ = structured.from_typed_envelope(spark.read.text(path).withColumnRenamed("value", "line"))
    shown = lambda fs: F.array_join(F.transform(fs, lambda f: F.concat(F.hex(f["field"]), F.lit("="), F.hex(f["value"]))), ";")
    number = lambda m: F.when(m["score"] == float("inf"), "up").otherwise(m["score"].cast("long").cast("string"))
    flat = F.coalesce(
        F.hex("text"), F.array_join(F.transform("members", F.hex), ","), F.array_join(F.transform("fields", lambda f: F.concat(F.hex(f["field"]), F.lit("="), F.hex(f["value"]))), ","),
        F.array_join(F.transform("scored", lambda m: F.concat(F.hex(m["member"]), F.lit("="), number(m))), ","),
        F.array_join(F.transform("entries", lambda e: F.concat(F.hex(F.encode(e["id"], "UTF-8")), F.lit(":"), shown(e["fields"]))), ","),
    )
    return good.select(F.decode("key", "UTF-8").alias("key"), "type", "ttl_ms", flat.alias("flat"))


@query("merged_hashes", """WITH l AS (SELECT l_orderkey AS o, l_suppkey % 3 AS f, l_partkey AS v, CASE WHEN l_partkey % 2 = 0 THEN l_suppkey END AS e, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem),
m AS (SELECT o, f, min(n) AS n, arg_max(v, n) AS v, arg_max(e, n) FILTER (e IS NOT NULL) AS e FROM l GROUP BY 1, 2)
SELECT CAST(o AS VARCHAR) AS key, string_agg(CAST(f AS VARCHAR) || '=' || CAST(v AS VARCHAR) || '@' || coalesce(CAST(e AS VARCHAR), '-'), ',' ORDER BY n) AS fields FROM m GROUP BY o""")
def merged_hashes(spark, sf):
    """Each order's lines as chunks of a hash in which fields repeat."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    text = lambda c: F.col(c).cast("string")
    field = F.struct((F.col("l_suppkey") % 3).cast("string").alias("field"), text("l_partkey").alias("value"), F.when(F.col("l_partkey") % 2 == 0, F.col("l_suppkey").cast("long")).alias("expire_at_ms"))
    chunks = table(spark, sf, "lineitem").select(
        text("l_orderkey").alias("key"), F.lit("hash").alias("type"), (F.row_number().over(order) - 1).alias("chunk"),
        F.count("*").over(Window.partitionBy("l_orderkey")).cast("int").alias("chunks"), F.array(field).alias("fields"),
    )
    done, _, _ = structured.join_hash_chunks(chunks)
    one = F.transform("fields", lambda f: F.concat(f["field"], F.lit("="), f["value"], F.lit("@"), F.coalesce(f["expire_at_ms"].cast("string"), F.lit("-"))))
    return done.select("key", F.array_join(one, ",").alias("fields"))
