"""Registered queries of bucketed targets, positions, generations, hooks and files, each with the SQL that must agree with it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions import structured
from keyloom.functions.keys import KeyNames
from keyloom.operators.buckets import BucketedTarget
from keyloom.operators import sync
from keyloom.operators.flow import Flow, record_hook
from keyloom.plans.queries import DIFFS, SOURCE_KV, TARGET_KV, event_stream, keyspaces
from keyloom.plans.registry import query
from keyloom.session import ensure_checkpoint_dir, ship_package, table
from keyloom.sources import lines, readers, sinks
from keyloom.streaming import follow


def shared(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def batches_of(records: DataFrame, n: int) -> list[DataFrame]:
    """All records, dealt to n micro-batches."""
    return [records.filter(F.pmod(F.xxhash64("key"), F.lit(n)) == i) for i in range(n)]


@query("bucketed_upsert", SOURCE_KV + " UNION ALL SELECT * FROM (" + TARGET_KV + ") x WHERE key LIKE 'order:x%'")
def bucketed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The source applied to a table of buckets in three commits, of which the last is replayed, and folded."""
    src, tgt = keyspaces(spark, sf)
    target = BucketedTarget.create(tgt, shared(spark, "target"), 64)
    parts = batches_of(src, 3)
    for number in (0, 1, 2, 2):
        target.apply(parts[number], number)
    target.compact(2)
    return target.read()


@query("bucketed_conflicts", f"""WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}) SELECT s.key, CASE WHEN t.key IS NULL THEN 'success' ELSE 'failure' END AS outcome,
 CASE WHEN t.key IS NOT NULL THEN 'the key already exists on the target and conflict-strategy is FAIL' END AS reason FROM s LEFT JOIN t ON s.key = t.key""")
def bucketed_conflicts(spark, sf):
    """Outcomes of two commits that must not replace anything."""
    src, tgt = keyspaces(spark, sf)
    target = BucketedTarget.create(tgt, shared(spark, "target"), 64)
    first, second = (target.apply(part, number, "FAIL") for number, part in enumerate(batches_of(src, 2)))
    return first.unionByName(second)


@query("bucketed_versions", f"WITH t AS ({TARGET_KV}), s AS ({SOURCE_KV}) SELECT 0 AS version, type, count(*) AS n FROM t GROUP BY type UNION ALL SELECT 1, type, count(*) FROM t WHERE key NOT IN (SELECT key FROM s WHERE type = 'hash') GROUP BY type")
def bucketed_versions(spark, sf):
    """Keys by type before and after a commit of deletions: what the first version was can still be read."""
    src, tgt = keyspaces(spark, sf)
    target = BucketedTarget.create(tgt, shared(spark, "target"), 32)
    target.apply(src.filter("type = 'hash'").withColumn("type", F.lit("deleted")), 0)
    count = lambda v: target.read(v).groupBy("type").agg(F.count("*").alias("n")).select(F.lit(v).alias("version"), "type", "n")
    return count(0).unionByName(count(1))


FOLLOWED = "SELECT user_id % 3 AS shard, event_id AS o, user_id AS key, event_type FROM events"


@query("saveable_positions", f"""WITH e AS ({FOLLOWED}), d AS (SELECT key, max(o) AS done FROM e WHERE event_type IN ('click', 'view', 'purchase') GROUP BY key)
SELECT CAST(shard AS BIGINT) AS shard, coalesce(min(CASE WHEN done IS NULL OR done < o THEN o - 1 END), max(o)) AS "offset" FROM e LEFT JOIN d ON e.key = d.key GROUP BY shard""")
def saveable_positions(spark, sf):
    """Up to where each shard's changes are all written; clicks, views and purchases stand for what has been."""
    e, u = table(spark, sf, "events"), F.col("user_id")
    changes = e.select((u % 3).cast("long").alias("shard"), F.col("event_id").alias("offset"), u.alias("key"))
    done = e.filter(F.col("event_type").isin("click", "view", "purchase")).select(u.alias("key"), F.col("event_id").alias("offset"))
    return follow.saveable_offsets(changes, done)


@query("bootstrap_generations", """WITH s AS (SELECT user_id % 3 AS shard, 1 + user_id % 2 AS generation, 1000 * (1 + user_id % 2) AS o, user_id AS key FROM events WHERE event_type = 'view'),
n AS (SELECT shard, max(generation) AS g, max_by(o, generation) AS o FROM s GROUP BY shard)
SELECT s.shard, s.key, CAST(-1 AS BIGINT) AS seq FROM s JOIN n ON s.shard = n.shard AND s.generation = n.g
UNION ALL SELECT e.user_id % 3, e.user_id, e.event_id FROM events e JOIN n ON e.user_id % 3 = n.shard AND CASE WHEN event_type = 'error' THEN 1 ELSE 2 END = n.g AND e.event_id > n.o""")
def bootstrap_generations(spark, sf):
    """Listings and then changes of the newest generation alone; errors stand for changes of the generation before."""
    e, u = table(spark, sf, "events"), F.col("user_id")
    snapshot = e.filter("event_type = 'view'").select((u % 3).alias("shard"), (1 + u % 2).alias("generation"), (1000 * (1 + u % 2)).alias("offset"), u.alias("key"))
    changes = e.select((u % 3).alias("shard"), F.when(F.col("event_type") == "error", 1).otherwise(2).alias("generation"), F.col("event_id").alias("offset"), u.alias("key"))
    return readers.bootstrap_then_follow(snapshot, changes)


@query("text_cursor", "SELECT max_by(CAST(o_custkey AS VARCHAR), o_orderkey) AS cursor FROM orders WHERE CAST(o_orderstatus AS VARCHAR) > 'F'")
def text_cursor(spark, sf):
    """The cursor of the last row in the query's order, which is not the largest one of its column."""
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").cast("string").alias("at")).createOrReplaceTempView("_keyloom_texts")
    return readers.read_incremental(spark, "select * from _keyloom_texts where o_orderstatus > '${cursor}' order by o_orderkey", "at", "F")[1]


# ---- the hook, on every way into a target


def tariff(rate: int):
    """User code: drops orders that are open, fails those without a price level, marks the others."""

    def hook(r: dict) -> dict | None:
        status, _, level = r["value"].partition("|")
        if status == "O":
            return None
        if level.startswith("4"):
            raise ValueError(f"no level {level[0]}")
        return r | {"value": f"{status}*{rate}", "ttl_ms": r["ttl_ms"] if r["ttl_ms"] > 0 else -1}

    return hook


HOOKED = f"""s AS ({SOURCE_KV}), t AS ({TARGET_KV}), h AS (SELECT *, split_part(value, '|', 1) || '*3' AS changed, value LIKE 'O|%' AS dropped, value NOT LIKE 'O|%' AND value LIKE '%|4%' AS failed FROM s)"""
WRITES = "SELECT 'sync:' || substr(key, 7) AS key, type, ttl_ms, size, changed AS value, NULL AS reason FROM h WHERE NOT dropped AND NOT failed"
FAILS = "SELECT key, NULL, NULL, NULL, NULL, 'no level 4' FROM h WHERE failed"
STAYS = "SELECT 'sync:' || substr(key, 7), type, ttl_ms, size, value, NULL FROM t WHERE key NOT IN (SELECT key FROM h WHERE NOT dropped AND NOT failed)"


def hooked(spark, sf, way) -> DataFrame:
    """What stands in the target after one way through a flow, and what failed."""
    ship_package(spark)
    src, tgt = keyspaces(spark, sf)
    renamed = tgt.withColumn("key", F.concat(F.lit("sync:"), F.substring("key", 7, 1 << 20)))
    new, outcomes = way(Flow(record_hook(tariff(3)), KeyNames.parse("order:=sync:")), src, renamed)
    failed = outcomes.filter("outcome = 'failure'").select("key", "reason")
    return new.withColumn("reason", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


@query("hook_copy", f"WITH {HOOKED} {WRITES} UNION ALL {FAILS} UNION ALL {STAYS}")
def hook_copy(spark, sf):
    return hooked(spark, sf, lambda flow, src, tgt: flow.copy(src, tgt))


@query("hook_live", f"WITH {HOOKED} {WRITES} AND type <> 'zset' UNION ALL {FAILS} AND type <> 'zset' UNION ALL SELECT 'sync:' || substr(key, 7), type, ttl_ms, size, value, NULL FROM t WHERE key NOT IN (SELECT key FROM h WHERE type = 'zset' OR NOT dropped AND NOT failed)")
def hook_live(spark, sf):
    """Every key of the source was changed; keys of a type out of scope are deleted, which the hook does not see."""
    live = lambda flow, src, tgt: Flow(flow.hook, flow.names, ("string", "hash", "list", "set", "stream")).live(src.select("key"), src, tgt)
    return hooked(spark, sf, live)


@query("hook_repair", f"""WITH {HOOKED}, d AS (SELECT coalesce(s.key, t.key) AS k FROM s FULL JOIN t ON s.key = t.key WHERE s.key IS NULL OR t.key IS NULL OR s.type <> t.type OR s.size <> t.size OR s.value <> t.value
  OR (s.ttl_ms > 0) <> (t.ttl_ms > 0) OR (s.ttl_ms > 0 AND abs(s.ttl_ms - t.ttl_ms) > 5000))
{WRITES} AND key IN (SELECT k FROM d) UNION ALL {FAILS} AND key IN (SELECT k FROM d)
UNION ALL SELECT 'sync:' || substr(key, 7), type, ttl_ms, size, value, NULL FROM t WHERE key NOT IN (SELECT k FROM d WHERE k NOT IN (SELECT key FROM h WHERE dropped OR failed))""")
def hook_repair(spark, sf):
    from keyloom.operators import reconcile

    def repair(flow, src, tgt):
        same = tgt.withColumn("key", F.concat(F.lit("order:"), F.substring("key", 6, 1 << 20)))
        return flow.repair(reconcile.first_differences(src, same), src, tgt)

    return hooked(spark, sf, repair)


@query("hook_import", f"WITH {HOOKED} SELECT key, type, ttl_ms, value, reason FROM ({WRITES} UNION ALL {FAILS})")
def hook_import(spark, sf):
    """The source from a JSON-lines file into an empty target."""
    ship_package(spark)
    src, path = keyspaces(spark, sf)[0], shared(spark, "lines")
    sinks.write_key_records(src.select(F.encode("key", "UTF-8").alias("key"), "type", "ttl_ms", F.encode("value", "UTF-8").alias("value")), path)
    good, _ = readers.read_key_records(spark, path)
    records = good.select(F.decode("key", "UTF-8").alias("key"), "type", "ttl_ms", F.decode("value", "UTF-8").alias("value"))
    new, outcomes = Flow(record_hook(tariff(3)), KeyNames.parse("order:=sync:")).ingest(records, records.limit(0))
    failed = outcomes.filter("outcome = 'failure'").select("key", "reason")
    return new.withColumn("reason", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


# ---- files


@query("typed_backup", """SELECT 'cust:' || CAST(c_custkey AS VARCHAR) AS key, CASE c_custkey % 3 WHEN 0 THEN 'hash' WHEN 1 THEN 'list' ELSE 'zset' END AS type, CAST(-1 AS BIGINT) AS ttl_ms,
 CASE c_custkey % 3 WHEN 0 THEN 'name=' || c_name || ',segment=' || c_mktsegment WHEN 1 THEN c_name || ',' || c_mktsegment ELSE c_name || '=' || CAST(c_nationkey AS VARCHAR) END AS content FROM customer""")
def typed_backup(spark, sf):
    """Hashes, lists and sorted sets written as JSON lines and read again."""
    c, path = table(spark, sf, "customer"), shared(spark, "backup")
    data = lambda name: F.encode(name, "UTF-8")
    kind = F.element_at(F.array(F.lit("hash"), F.lit("list"), F.lit("zset")), (F.col("c_custkey") % 3 + 1).cast("int"))
    pair = lambda f, v: F.struct(F.encode(F.lit(f), "UTF-8").alias("field"), data(v).alias("value"))
    records = c.select(
        F.encode(F.concat(F.lit("cust:"), F.col("c_custkey").cast("string")), "UTF-8").alias("key"), kind.alias("type"), F.lit(-1).cast("long").alias("ttl_ms"),
        F.when(kind == "hash", F.array(pair("name", "c_name"), pair("segment", "c_mktsegment"))).alias("fields"), F.when(kind == "list", F.array(data("c_name"), data("c_mktsegment"))).alias("members"),
        F.when(kind == "zset", F.array(F.struct(data("c_name").alias("member"), F.col("c_nationkey").cast("double").alias("score")))).alias("scored"),
    )
    sinks.write_key_records(records, path)
    good, _ = readers.read_key_records(spark, path, typed=True)
    text = lambda b: b.cast("string")
    content = F.coalesce(
        F.array_join(F.transform("fields", lambda f: F.concat(text(f["field"]), F.lit("="), text(f["value"]))), ","), F.array_join(F.transform("members", text), ","),
        F.array_join(F.transform("scored", lambda m: F.concat(text(m["member"]), F.lit("="), m["score"].cast("long").cast("string"))), ","),
    )
    return good.select(text(F.col("key")).alias("key"), "type", "ttl_ms", content.alias("content"))


LINE = "'{\"id\":' || CAST(c_custkey AS VARCHAR) || ',\"name\":\"' || c_name || '\"}'"


@query("line_positions", f"""WITH l AS (SELECT c_custkey, {LINE} AS line FROM customer), p AS (SELECT *, coalesce(sum(octet_length(encode(line)) + 1) OVER (ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS byte FROM l)
SELECT CAST(byte AS BIGINT) AS byte, CAST(byte + octet_length(encode(line)) + 1 AS BIGINT) AS "next", line FROM p""")
def line_positions(spark, sf):
    """Every line of a file with the byte at which it begins, read in two parts: up to a saved position, and on from there."""
    ship_package(spark)
    path, key = shared(spark, "lines"), F.col("c_custkey").cast("string")
    text = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit('{"id":'), key, F.lit(',"name":"'), "c_name", F.lit('"}')).alias("line"))
    text.coalesce(1).sortWithinPartitions("c_custkey").select("line").write.text(path)
    every = lines.with_positions(lines.raw_lines(spark, path))
    middle = every.agg(F.max("next").alias("m")).first()["m"] // 2
    first = every.filter(F.col("byte") <= middle)
    return first.unionByName(lines.after(every, lines.read_up_to(first))).select("byte", "next", "line")


@query("field_expiry_commands", """WITH f AS (SELECT l_orderkey AS k, 'f' || CAST(l_linenumber AS VARCHAR) AS field, max(l_partkey) AS v, CASE WHEN l_linenumber % 3 <> 0 THEN 10000 + (l_orderkey % 4 - 1) * 1500 END AS due FROM lineitem GROUP BY l_orderkey, l_linenumber),
a AS (SELECT k, field, v, CAST(ceil((due - 10000) / 1000.0) AS BIGINT) AS s FROM f WHERE due IS NULL OR due > 10000),
c AS (SELECT k, 1 AS o, 'DEL' AS line FROM (SELECT DISTINCT k FROM f) UNION ALL SELECT k, 2, 'HSET ' || string_agg(field || ' ' || CAST(v AS VARCHAR), ' ' ORDER BY field) FROM a GROUP BY k
UNION ALL SELECT k, 3, 'HEXPIRE ' || CAST(s AS VARCHAR) || ' FIELDS ' || CAST(count(*) AS VARCHAR) || ' ' || string_agg(field, ' ' ORDER BY field) FROM a WHERE s IS NOT NULL GROUP BY k, s)
SELECT 'h:' || CAST(k AS VARCHAR) AS key, CAST(row_number() OVER (PARTITION BY k ORDER BY o) - 1 AS INTEGER) AS seq, line FROM c""")
def field_expiry_commands(spark, sf):
    """Commands that rebuild hashes with deadlines on some of their fields; now is 10,000."""
    item = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").cast("string").alias("value"))
    due = F.when(F.col("l_linenumber") % 3 != 0, 10000 + (F.col("l_orderkey") % 4 - 1) * 1500).cast("long")
    field = F.struct(F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias("field"), "value", due.alias("expire_at_ms"))
    hashes = item.groupBy(F.concat(F.lit("h:"), F.col("l_orderkey").cast("string")).alias("key")).agg(F.array_sort(F.collect_list(field)).alias("fields"))
    commands = structured.field_ttl_commands(hashes.withColumn("ttl_ms", F.lit(-1).cast("long")), F.lit(10000))
    words = F.concat(F.slice("argv", 1, 1), F.slice("argv", 3, 1 << 20))
    return commands.select("key", "seq", F.array_join(words, " ").alias("line"))


# ---- advice from facts to a way to copy, in one job

FACTS_SQL = """f AS (SELECT s_suppkey AS k, CASE s_suppkey % 2 WHEN 0 THEN 'redis' ELSE 'valkey' END AS family, 5 + s_suppkey % 5 AS major, s_suppkey % 3 * 2 AS minor, s_suppkey % 5 = 0 AS clustered, s_suppkey % 6 = 0 AS managed,
 s_suppkey % 11 <> 0 AS known, s_suppkey % 4 <> 0 AS new_target, s_suppkey % 4 AS target_keys, s_suppkey % 10 AS used, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 8 END AS target_max, s_suppkey * 100000 AS keys,
 CASE WHEN s_suppkey % 7 = 0 THEN 2 ELSE 0 END AS functions, CASE s_suppkey % 8 WHEN 0 THEN 'graph' WHEN 1 THEN 'search' WHEN 2 THEN 'rejson' WHEN 3 THEN 'bf' WHEN 4 THEN 'custom' WHEN 5 THEN 'vectorset' END AS module,
 CASE WHEN s_suppkey % 23 = 0 THEN 2 ELSE 0 END AS indexes, s_suppkey % 9 = 0 AS aof, s_suppkey % 3 = 0 AS events, s_suppkey % 13 = 0 AS blocked, s_suppkey % 17 = 0 AS cerr, s_suppkey % 19 = 0 AS aerr, s_suppkey % 2 = 0 AS cache, s_suppkey % 29 = 0 AS same,
 s_suppkey % 7 IN (1, 2) AS limited FROM supplier),
cmd AS (SELECT l_suppkey AS k, ['eval', 'ts.add', 'client|tracking', 'hello', 'hexpire', 'get', 'other', 'config|set'][l_suppkey % 7 + l_partkey % 2 + 1] AS c FROM lineitem GROUP BY 1, 2),
typ AS (SELECT l_suppkey AS k, ['string', 'hash', 'rejson-rl', 'mbbloom--', 'topk-type', 'strange'][l_suppkey % 5 + l_linenumber % 2 + 1] AS t FROM lineitem GROUP BY 1, 2),
c AS (SELECT f.*, family = 'redis' AND major < 8 OR family = 'valkey' AND major < 8 AS known_format, family = 'redis' AND (major, minor) >= (7, 4) AS field_ttl,
 family = 'redis' AND (major, minor) >= (7, 2) AND (major, minor) < (7, 4) OR FALSE AS fmt11, family = 'redis' AND (major, minor) >= (7, 4) AND major < 8 AS fmt12,
 EXISTS (SELECT 1 FROM cmd WHERE cmd.k = f.k AND c = 'client|tracking') AS tracking, EXISTS (SELECT 1 FROM cmd WHERE cmd.k = f.k AND c = 'hello') AS hello, EXISTS (SELECT 1 FROM cmd WHERE cmd.k = f.k AND c = 'hexpire') AS hexpire,
 EXISTS (SELECT 1 FROM typ WHERE typ.k = f.k AND t = 'rejson-rl') AS json, EXISTS (SELECT 1 FROM typ WHERE typ.k = f.k AND t = 'topk-type') AS topk, EXISTS (SELECT 1 FROM typ WHERE typ.k = f.k AND t = 'mbbloom--') AS bloom, managed OR blocked AS closed FROM f)"""
FINDINGS_SQL = """g AS (SELECT k, 'action' AS s, [1, 2, 3] AS p FROM c WHERE NOT known UNION ALL SELECT k, 'check', [1, 2, 3] FROM c WHERE known AND NOT new_target UNION ALL SELECT k, 'check', [2, 3] FROM c WHERE target_keys > 0
UNION ALL SELECT k, CASE WHEN family = 'valkey' AND major >= 9 AND NOT new_target THEN 'action' ELSE 'check' END, [2] FROM c WHERE NOT known_format UNION ALL SELECT k, 'info', [2] FROM c WHERE known_format
UNION ALL SELECT k, 'info', [2] FROM c WHERE fmt12 AND clustered UNION ALL SELECT k, 'info', [1, 2, 3] FROM c WHERE family = 'valkey' AND major < 8 UNION ALL SELECT k, 'check', [1, 2, 3] FROM c WHERE cerr UNION ALL SELECT k, 'action', [1, 2, 3] FROM c WHERE functions > 0
UNION ALL SELECT k, CASE module WHEN 'graph' THEN 'stop' WHEN 'rejson' THEN 'info' WHEN 'custom' THEN 'action' ELSE 'check' END, [1, 2, 3] FROM c WHERE module <> 'vectorset'
UNION ALL SELECT k, 'action', [1, 2, 3] FROM c WHERE limited UNION ALL SELECT k, 'check', [1, 2, 3] FROM c WHERE NOT limited AND aerr UNION ALL SELECT k, CASE WHEN hello THEN 'check' ELSE 'action' END, [1, 2, 3] FROM c WHERE tracking
UNION ALL SELECT k, 'action', [1, 2, 3] FROM c WHERE tracking AND known AND NOT new_target UNION ALL SELECT k, 'check', [1, 2, 3] FROM c WHERE clustered UNION ALL SELECT k, 'check', [3] FROM c WHERE clustered UNION ALL SELECT k, 'check', [1, 2, 3] FROM c WHERE aof
UNION ALL SELECT k, 'check', [3] FROM c WHERE managed UNION ALL SELECT k, 'check', [3] FROM c WHERE blocked UNION ALL SELECT k, 'action', [3] FROM c WHERE NOT blocked AND NOT events UNION ALL SELECT k, 'info', [3] FROM c UNION ALL SELECT k, 'stop', [2, 3] FROM c WHERE target_max > 0 AND used > target_max
UNION ALL SELECT k, CASE t WHEN 'rejson-rl' THEN 'info' WHEN 'strange' THEN 'action' ELSE 'check' END, CASE WHEN t IN ('rejson-rl', 'strange') THEN [1, 2, 3] ELSE [2, 3] END FROM typ WHERE t NOT IN ('string', 'hash')
UNION ALL SELECT k, CASE c WHEN 'ts.add' THEN 'stop' ELSE 'check' END, [1, 2, 3] FROM cmd WHERE c IN ('eval', 'ts.add') UNION ALL SELECT k, 'action', [1, 2, 3] FROM cmd WHERE c IN ('hexpire', 'hello', 'other') GROUP BY k)"""
ADVICE_SQL = f"""WITH {FACTS_SQL}, {FINDINGS_SQL}, n AS (SELECT k, count(*) FILTER (s = 'stop') AS stop, count(*) FILTER (s = 'action') AS action, count(*) FILTER (s = 'check') AS "check", count(*) FILTER (s = 'info') AS info FROM g GROUP BY k),
w AS (SELECT k, p, max(CASE s WHEN 'stop' THEN 3 WHEN 'action' THEN 2 WHEN 'check' THEN 1 ELSE 0 END) AS r FROM (SELECT k, s, unnest(p) AS p FROM g) GROUP BY 1, 2),
e AS (SELECT c.k, cache, x.p, coalesce(r, 0) AS r, CASE WHEN cache THEN x.p ELSE (x.p + 1) % 3 END AS o FROM c, (VALUES (1), (2), (3)) x(p) LEFT JOIN w ON w.k = c.k AND w.p = x.p),
b AS (SELECT k, coalesce(min_by(p, o) FILTER (r = 0), min_by(p, o) FILTER (r < 3)) AS pattern, bool_or(r = 0) AS ready, string_agg(r, '' ORDER BY p) AS statuses FROM e GROUP BY k),
t AS (SELECT k, cache, clustered, closed, same, keys, bloom, CAST(same AS INT) + CAST(family = 'redis' AND major >= 8 OR major >= 9 AS INT) + CAST(hexpire AND field_ttl AS INT) + CAST(json OR coalesce(module, '') = 'rejson' AS INT) + CAST(topk AS INT)
 + CAST(indexes > 0 AS INT) + CAST(NOT cache AS INT) + CAST(clustered AS INT) + CAST(keys >= 5000000 AS INT) + CAST(bloom AND NOT same AS INT) AS typed,
 CAST(topk AS INT) + CAST(NOT same AS INT) AS limits, CAST(bloom AND NOT same AS INT) + CAST(target_keys > 0 AS INT) + CAST(closed AND NOT same AS INT) AS checks FROM c)
SELECT t.k AS source, stop, action, "check", info, statuses, pattern, ready, CASE WHEN typed > 0 THEN 'typed' WHEN cache AND NOT (bloom AND NOT same) THEN 'payload' ELSE 'any' END AS tool,
 CASE WHEN typed > 0 THEN CASE WHEN cache THEN 'once' WHEN same THEN 'passes' WHEN clustered AND NOT closed THEN 'log' ELSE 'events' END END AS way, typed,
 limits + CAST(NOT (cache AND typed = 0 AND NOT (bloom AND NOT same)) AND keys >= 1000000 AS INT) AS limits, checks FROM t JOIN n ON n.k = t.k JOIN b ON b.k = t.k"""


def fleet(spark, sf):
    """Measures of suppliers that stand for sources, and the commands and rules that findings need."""
    from keyloom.operators import advice

    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    pick = lambda names, n: F.element_at(F.array(*(F.lit(x) for x in names)), (n + 1).cast("int"))
    facts = s.select(
        k.alias("source"), pick(("redis", "valkey"), k % 2).alias("family"), F.concat_ws(".", (5 + k % 5).cast("string"), (k % 3 * 2).cast("string"), F.lit("0")).alias("version"),
        F.when(k % 5 == 0, "cluster").otherwise("single").alias("mode"), F.when(k % 6 == 0, "c1.cache.amazonaws.com").otherwise("10.0.0.1").alias("host"), (k % 11 != 0).alias("target_known"),
        F.when(k % 4 != 0, "2.1.0").otherwise("1.13.0").alias("target_version"), (k % 4).alias("target_keys"), (k % 10).alias("used"), F.when(k % 3 == 0, 0).otherwise(8).alias("target_max"), (k * 100000).alias("keys"),
        F.when(k % 7 == 0, 2).otherwise(0).alias("functions"), F.array_compact(F.array(pick(("graph", "search", "rejson", "bf", "custom", "vectorset", None, None), k % 8))).alias("modules"),
        F.when(k % 23 == 0, 2).otherwise(0).alias("indexes"), (k % 9 == 0).alias("aof"), pick(("AE", "KEg$", None), k % 3).alias("notify"), (k % 13 == 0).alias("config_blocked"), (k % 17 == 0).alias("command_error"),
        (k % 19 == 0).alias("acl_error"), F.when(k % 2 == 0, "allkeys-lru").otherwise("noeviction").alias("policy"), (k % 29 == 0).alias("same_engine"),
    )
    item, sup = table(spark, sf, "lineitem"), F.col("l_suppkey")
    counts = lambda name, c: item.groupBy(sup.alias("source"), c.alias(name)).agg(F.count("*").alias("n"))
    commands = counts("command", pick(("eval", "ts.add", "client|tracking", "hello", "hexpire", "get", "other", "config|set"), sup % 7 + F.col("l_partkey") % 2))
    types = counts("type", pick(("string", "hash", "ReJSON-RL", "MBbloom--", "TopK-TYPE", "strange"), sup % 5 + F.col("l_linenumber") % 2))
    acls = s.select(k.alias("source"), F.lit("u").alias("user"), pick(("on ~* &* +@all", "on ~app:* +@all", "on ~* (+get ~x)", "on ~* +@all", "on ~* +@all", "off", "on ~* &* +get"), k % 7).alias("rule"))
    formats = [(f, v, n) for f, v, n in (("redis", "3.2.0", "7"), ("redis", "4.0.0", "8"), ("redis", "5.0.0", "9"), ("redis", "7.0.0", "10"), ("redis", "7.2.0", "11"), ("redis", "7.4.0", "12"), ("redis", "8.0.0", None), ("valkey", "0.0.0", "11"), ("valkey", "8.0.0", None))]
    ranges = spark.createDataFrame(formats, "family string, from_version string, format string")
    rules = spark.createDataFrame([("exact", 1, "eval", "lua", "check"), ("prefix", 2, "ts.", "series", "stop")], "kind string, position int, pattern string, title string, severity string")
    wide = advice.measures(facts, commands, types, acls, ranges)
    found = advice.findings(wide, commands, rules, spark.createDataFrame([("get",), ("eval",)], "command string"), ["client", "config"])
    return wide, found


@query("advice", ADVICE_SQL)
def advice_of_sources(spark, sf):
    """From facts to findings, statuses, a pattern and a way to copy, for every source."""
    from keyloom.operators import advice, assess

    got = advice.advise(*fleet(spark, sf))
    rank = {s: n for n, s in assess.STATUS.items()}
    number = F.create_map(*(F.lit(x) for s, n in rank.items() for x in (s, str(n))))
    statuses = F.array_join(F.transform(F.array(*map(F.lit, (1, 2, 3))), lambda p: number[F.col("statuses")[p]]), "").alias("statuses")
    return got.select("source", "stop", "action", "check", "info", statuses, "pattern", "ready", "tool", "way", F.size("typed").alias("typed"), F.size("limits").alias("limits"), F.size("checks").alias("checks"))


@query("advice_titles", f"""WITH {FACTS_SQL} SELECT k AS source, 'the target already holds ' || target_keys || ' keys' AS title FROM c WHERE target_keys > 0 UNION ALL SELECT k, used || ' bytes do not fit into ' || target_max FROM c WHERE target_max > 0 AND used > target_max
UNION ALL SELECT k, 'key events are ''' || CASE k % 3 WHEN 1 THEN 'KEg$' ELSE 'none' END || '''' FROM c WHERE NOT blocked AND NOT events UNION ALL SELECT k, 'snapshots have format ' || CASE WHEN family = 'valkey' THEN '11' WHEN major < 7 THEN '9' WHEN minor < 2 THEN '10' WHEN minor < 4 THEN '11' ELSE '12' END FROM c WHERE known_format
UNION ALL SELECT k, 'the type strange is not known' FROM typ WHERE t = 'strange' UNION ALL SELECT k, 'the target lacks ' || string_agg(c, ', ' ORDER BY c) FROM cmd WHERE c IN ('hexpire', 'hello', 'other') GROUP BY k""")
def advice_titles(spark, sf):
    """Findings whose text has measures in it."""
    found = fleet(spark, sf)[1]
    return found.filter(F.col("title").rlike("holds|do not fit|key events are|have format|is not known$|target lacks") & ~F.col("title").rlike("^the snapshot")).select("source", "title")


# ---- passes, totals, frequent items


@query("differential_pass", DIFFS + " SELECT key, reason FROM d WHERE reason IS NOT NULL")
def differential_pass(spark, sf):
    """The differences of a full pass, from the buckets of keys that do not agree."""
    from keyloom.operators import passes

    return passes.differential_pass(*keyspaces(spark, sf), buckets=8192)[0]


PASSES = "p AS (SELECT user_id AS run_id, event_id AS started_at, CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL ELSE event_id + 5 END AS finished_at, CASE WHEN event_id % 2 = 0 THEN 'FULL' ELSE 'SAMPLE' END AS mode FROM events WHERE event_type IN ('click', 'error'))"


@query("passes_to_begin", f"""WITH {PASSES}, n AS (SELECT DISTINCT user_id AS run_id, (SELECT max(event_id) FROM events) + 100 AS now FROM events),
l AS (SELECT run_id, max(started_at) FILTER (mode = 'FULL') AS f, max(finished_at) AS e, max(mode) FILTER (finished_at IS NULL) AS running FROM p GROUP BY run_id),
a AS (SELECT user_id AS run_id, max(event_id) AS asked FROM events LEFT JOIN l ON l.run_id = user_id WHERE event_type = 'signup' AND (f IS NULL OR event_id >= f) GROUP BY 1),
m AS (SELECT n.run_id, a.run_id IS NOT NULL AND coalesce(running, '') <> 'FULL' AS wanted, a.run_id IS NULL AND running IS NULL AND (e IS NULL OR now - e >= 200) AS idle, a.asked FROM n LEFT JOIN l USING (run_id) LEFT JOIN a USING (run_id))
SELECT run_id, CASE WHEN wanted THEN 'FULL' ELSE 'SAMPLE' END AS mode, CASE WHEN wanted THEN 'a size drop at ' || CAST(asked AS VARCHAR) ELSE 'schedule' END AS trigger FROM m WHERE wanted OR idle""")
def passes_to_begin(spark, sf):
    """Which runs begin a pass: signups stand for size drops, clicks and errors for passes."""
    from keyloom.operators import passes

    e, at = table(spark, sf, "events"), F.col("event_id")
    past = e.filter("event_type in ('click', 'error')").select(
        F.col("user_id").alias("run_id"), at.alias("started_at"), F.when((F.col("event_type") == "error") & (at % 3 == 0), None).otherwise(at + 5).alias("finished_at"), F.when(at % 2 == 0, "FULL").otherwise("SAMPLE").alias("mode"),
    )
    asked = e.filter("event_type = 'signup'").select(F.col("user_id").alias("run_id"), at.alias("at"), F.concat(F.lit("a size drop at "), at.cast("string")).alias("trigger"))
    now = e.agg(F.max("event_id").alias("m")).first()["m"] + 100
    return passes.pass_due(past, asked, e.select(F.col("user_id").alias("run_id")).distinct().withColumn("now", F.lit(now)), 200)


@query("live_totals", """WITH e AS (SELECT user_id % 7 AS run_id, * FROM events), c AS (SELECT run_id, event_type AS name, count(*) AS total FROM e GROUP BY 1, 2),
s AS (SELECT run_id, ts, event_id, CASE event_type WHEN 'error' THEN 'down' ELSE 'up' END AS state FROM e WHERE event_type IN ('error', 'click')), x AS (SELECT *, lag(state) OVER (PARTITION BY run_id ORDER BY ts, event_id) AS was FROM s),
y AS (SELECT *, lead(ts) OVER (PARTITION BY run_id ORDER BY ts, event_id) AS up_at FROM x WHERE was IS NULL OR was <> state), o AS (SELECT run_id, count(*) AS disconnects, coalesce(sum(CAST(floor(epoch(up_at)) - floor(epoch(ts)) AS BIGINT)), 0) AS downtime FROM y WHERE state = 'down' GROUP BY 1)
SELECT r.run_id, CAST(r.last - r.first AS BIGINT) AS elapsed, k.written, o.disconnects, CAST(o.downtime AS BIGINT) AS downtime, k.critical, k.advisory, k.orphans FROM (SELECT run_id, min(event_id) AS first, max(event_id) AS last FROM e GROUP BY 1) r
JOIN o USING (run_id) JOIN (SELECT run_id, count(*) FILTER (event_type = 'view') AS written, count(*) FILTER (event_type = 'purchase') AS critical, count(*) FILTER (event_type = 'signup') AS advisory, count(*) FILTER (event_type = 'error' AND event_id % 2 = 1) AS orphans FROM e GROUP BY 1) k USING (run_id)""")
def live_totals(spark, sf):
    """What the live phase of each run did and met, from its logs."""
    from keyloom.operators import runs

    e, kind = table(spark, sf, "events").withColumn("run_id", F.col("user_id") % 7), F.col("event_type")
    counts = e.groupBy("run_id", kind.alias("name")).agg(F.count("*").alias("total"))
    log = e.filter("event_type in ('error', 'click')").select("run_id", "ts", F.col("event_id").alias("seq"), F.when(kind == "error", "down").otherwise("up").alias("state"))
    moved = e.select("run_id", F.when(kind == "purchase", "CRITICAL").when(kind == "signup", "ADVISORY").otherwise("NONE").alias("severity"))
    letters = e.filter("event_type = 'error'").select("run_id", F.col("event_id").alias("key"), (F.col("event_id") % 2 == 0).alias("reviewed"))
    times = e.groupBy("run_id").agg(F.min("event_id").alias("started_at"), F.max("event_id").alias("finished_at"))
    got = runs.live_totals(counts, runs.outages(log), moved, letters, times)
    return got.select("run_id", "elapsed", F.col("counters")["view"].alias("written"), "disconnects", "downtime", "critical", "advisory", "orphans")


@query("frequent_items", "SELECT l_returnflag || l_linestatus || '/' || CAST(l_linenumber AS VARCHAR) AS item, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC LIMIT 12")
def frequent_items(spark, sf):
    """The most frequent items over ten runs, from a sketch of each; with fewer different items than counters estimates are exact."""
    from keyloom.operators import runs

    item = F.concat("l_returnflag", "l_linestatus", F.lit("/"), F.col("l_linenumber").cast("string"))
    return runs.frequent_items(runs.item_sketches(table(spark, sf, "lineitem").select((F.col("l_orderkey") % 10).alias("run_id"), item.alias("item")), 1000), 12, 1000)


@query("copy_rates", """WITH h AS (SELECT date_trunc('hour', ts) AS ts, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1), s AS (SELECT ts, sum(n) OVER (ORDER BY ts) AS target, (SELECT count(*) FROM events) AS source FROM h),
g AS (SELECT *, target - lag(target) OVER (ORDER BY ts) AS gained, CAST(epoch(ts) - epoch(lag(ts) OVER (ORDER BY ts)) AS BIGINT) AS s FROM s)
SELECT ts, CAST(target AS BIGINT) AS target, CASE WHEN s > 0 THEN gained / CAST(s AS DOUBLE) END AS rate, CASE WHEN target >= source THEN 'caught_up' ELSE 'copying' END AS state FROM g""")
def copy_rates(spark, sf):
    """Keys a second of a copy that is sampled by the hour."""
    from pyspark.sql import Window

    from keyloom.operators import runs

    e = table(spark, sf, "events")
    total = e.agg(F.count("*").alias("n")).first()["n"]
    hourly = e.filter("event_type <> 'error'").groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(F.count("*").alias("n"))  # a row an hour
    samples = hourly.select(F.lit(1).alias("run_id"), "ts", F.sum("n").over(Window.orderBy("ts")).alias("target"), F.lit(total).alias("source"))
    return runs.rates(samples, 3, 10**9).select("ts", "target", "rate", "state")


# ---- files of records and events, lookups that fail, streams with groups


@query("records_of_files", """SELECT 'part:' || CAST(p_partkey AS VARCHAR) AS key, 'json' AS type, CAST(86400000 AS BIGINT) AS ttl_ms, CAST(p_partkey AS VARCHAR) || '|' || p_name AS flat FROM part""")
def records_of_files(spark, sf):
    """Parts as files with a delimiter of their own, read as documents under a prefix and their primary key."""
    path = shared(spark, "delimited")
    table(spark, sf, "part").select("p_partkey", "p_name").write.option("header", True).option("sep", "|").csv(path)
    good, _ = readers.ingest_records(spark, path, "p_partkey", "json", "part", "custom", "|", r"part-.*\.csv", 86400000)
    return good.select("key", "type", "ttl_ms", F.concat_ws("|", F.get_json_object("value", "$.p_partkey"), F.get_json_object("value", "$.p_name")).alias("flat"))


@query("event_files", """SELECT CASE event_type WHEN 'error' THEN 'deleted' WHEN 'signup' THEN 'deleted' WHEN 'purchase' THEN 'expired' ELSE 'changed' END AS route, count(*) AS n, count(DISTINCT user_id) AS keys FROM events GROUP BY 1
UNION ALL SELECT 'failure', count(*), 0 FROM region""")
def event_files(spark, sf):
    """Events followed as a stream over files of JSON lines, some of which are no JSON, and counted by route."""
    path, out = shared(spark, "events"), shared(spark, "routed")
    event_stream(spark, sf).select("channel", "message", "ts").write.json(path)
    table(spark, sf, "region").select(F.concat(F.lit("no JSON: "), "r_name")).write.mode("append").text(path)
    routed = sync.route_events(readers.read_events(spark, path, file_format="json")).select("route", "key")
    routed.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("route string, key string").parquet(out).groupBy("route").agg(F.count("*").alias("n"), F.count_distinct("key").alias("keys"))


@query("existence_failures", """WITH k AS (SELECT 'cust:' || CAST(c_custkey AS VARCHAR) AS key, c_custkey AS n FROM customer),
a AS (SELECT n % 5 = 0 AS failed, * FROM k WHERE n % 3 <> 0)
SELECT k.key, CASE WHEN k.key LIKE 'cust:1%' THEN 'filtered' WHEN a.failed THEN 'failure' WHEN a.key IS NOT NULL THEN 'exists' ELSE 'missing' END AS route,
 CASE WHEN k.key NOT LIKE 'cust:1%' AND a.failed THEN 'the source could not be asked: timeout' END AS reason FROM k LEFT JOIN a ON a.key = k.key""")
def existence_failures(spark, sf):
    """Customers looked up in a source that does not have every third and does not answer for every fifth."""
    n = F.col("c_custkey")
    keys = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("cust:"), n.cast("string")).alias("key"))
    answers = keys.filter(n % 3 != 0).select("key", F.when(n % 5 == 0, "timeout").alias("error"))
    return sync.existence_routes(keys, answers, deny=["cust:1"]).select("key", "route", "reason")


@query("grouped_streams", """SELECT 's:' || CAST(user_id AS VARCHAR) AS key, count(*) AS entries, CAST(max(event_id) AS VARCHAR) || '-0' AS last_id,
CASE WHEN user_id % 2 = 0 THEN CASE WHEN user_id % 4 = 0 THEN 'FF' ELSE '67' END || ':63:' || CAST(min(event_id) AS VARCHAR) || '-0' END AS groups FROM events GROUP BY user_id""")
def grouped_streams(spark, sf):
    """Each user's events as a stream, some with a consumer group whose name may be no text, to JSON lines and back."""
    u, path, text = F.col("user_id"), shared(spark, "streams"), lambda c: F.concat(c.cast("string"), F.lit("-0"))
    s = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_list("event_id")).alias("e"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    consumer = F.encode(F.lit("c"), "UTF-8")
    pending = F.struct(text(F.col("lo")).alias("id"), consumer.alias("consumer"), F.lit(1000).cast("long").alias("delivered_at_ms"), F.lit(2).cast("long").alias("deliveries"))
    name = F.when(u % 4 == 0, F.unhex(F.lit("FF"))).otherwise(F.encode(F.lit("g"), "UTF-8"))
    group = F.struct(name.alias("name"), F.lit("0").alias("last_delivered_id"), u.cast("long").alias("entries_read"), F.array(consumer).alias("consumers"), F.array(pending).alias("pending"))
    records = s.select(
        F.encode(F.concat(F.lit("s:"), u.cast("string")), "UTF-8").alias("key"), F.lit("stream").alias("type"), F.lit(-1).cast("long").alias("ttl_ms"),
        F.transform("e", lambda e: F.struct(text(e).alias("id"), F.array().cast(structured.PAIRS).alias("fields"))).alias("entries"),
        text(F.col("hi")).alias("last_id"), F.when(u % 2 == 0, F.array(group)).alias("groups"),
    )
    sinks.write_key_records(records, path)
    good, _ = structured.from_typed_envelope(lines.raw_lines(spark, path).select("line"), groups=True)
    flat = F.transform("groups", lambda g: F.concat_ws(":", F.hex(g["name"]), F.hex(g["consumers"][0]), g["pending"][0]["id"]))
    return good.select(F.col("key").cast("string").alias("key"), F.size("entries").cast("long").alias("entries"), "last_id", F.array_join(flat, ",").alias("groups"))
