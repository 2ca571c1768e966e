"""The registered queries of the key-sync operators, each with the SQL that must agree with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions import keys, values
from keyloom.operators import assess, indexes, modules, reconcile, runs, sync, topology
from keyloom.plans.registry import ORACLE_SQL, QUERIES, query  # noqa: F401
from keyloom.sources import readers
from keyloom.streaming import live

SOURCE_KV = """SELECT CONCAT('order:', CAST(o_orderkey AS STRING)) AS key,
  CASE o_orderkey % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'hash' WHEN 2 THEN 'list'
       WHEN 3 THEN 'set' WHEN 4 THEN 'zset' ELSE 'stream' END AS type,
  CASE WHEN o_orderkey % 5 = 0 THEN 3600000 + (o_orderkey % 100) * 1000 ELSE -1 END AS ttl_ms,
  o_orderkey % 7 + 1 AS size, CONCAT(o_orderstatus, '|', o_orderpriority) AS value
FROM orders"""

TARGET_KV = """SELECT CONCAT('order:', CAST(o_orderkey AS STRING)) AS key,
  CASE WHEN o_orderkey % 89 = 0 THEN 'ReJSON-RL' ELSE
  CASE o_orderkey % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'hash' WHEN 2 THEN 'list'
       WHEN 3 THEN 'set' WHEN 4 THEN 'zset' ELSE 'stream' END END AS type,
  CASE WHEN o_orderkey % 5 = 0 THEN 3600000 + (o_orderkey % 100) * 1000
       + CASE WHEN o_orderkey % 83 = 0 THEN 60000 ELSE 0 END ELSE -1 END AS ttl_ms,
  o_orderkey % 7 + 1 + CASE WHEN o_orderkey % 79 = 0 THEN 1 ELSE 0 END AS size,
  CASE WHEN o_orderkey % 73 = 0 THEN CONCAT(o_orderstatus, '|X')
       ELSE CONCAT(o_orderstatus, '|', o_orderpriority) END AS value
FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT CONCAT('order:x', CAST(o_orderkey AS STRING)), 'string', -1, 1, 'extra'
FROM orders WHERE o_orderkey % 101 = 0"""


def keyspaces(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two keyspaces with known drift, derived from orders."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    k = F.col("o_orderkey")
    kind = F.element_at(F.array(*map(F.lit, ("string", "hash", "list", "set", "zset", "stream"))), (k % 6 + 1).cast("int"))
    ttl = F.when(k % 5 == 0, 3600000 + (k % 100) * 1000).otherwise(F.lit(-1).cast("long"))
    name = F.concat(F.lit("order:"), k.cast("string"))
    value = F.concat_ws("|", "o_orderstatus", "o_orderpriority")
    src = orders.select(name.alias("key"), kind.alias("type"), ttl.alias("ttl_ms"), (k % 7 + 1).alias("size"), value.alias("value"))
    tgt = orders.filter(k % 97 != 0).select(
        name.alias("key"),
        F.when(k % 89 == 0, "ReJSON-RL").otherwise(kind).alias("type"),
        F.when((k % 5 == 0) & (k % 83 == 0), ttl + 60000).otherwise(ttl).alias("ttl_ms"),
        (k % 7 + 1 + F.when(k % 79 == 0, 1).otherwise(0)).alias("size"),
        F.when(k % 73 == 0, F.concat("o_orderstatus", F.lit("|X"))).otherwise(value).alias("value"),
    )
    extra = orders.filter(k % 101 == 0).select(
        F.concat(F.lit("order:x"), k.cast("string")).alias("key"), F.lit("string").alias("type"),
        F.lit(-1).cast("long").alias("ttl_ms"), F.lit(1).cast("long").alias("size"), F.lit("extra").alias("value"),
    )
    return src, tgt.unionByName(extra)


@query("reconcile_full", f"""WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}),
d AS (SELECT CASE WHEN t.key IS NULL THEN 'missing_on_target' WHEN s.key IS NULL THEN 'extra_on_target'
  WHEN s.type <> t.type THEN 'type'
  WHEN (s.ttl_ms > 0) <> (t.ttl_ms > 0) OR (s.ttl_ms > 0 AND abs(s.ttl_ms - t.ttl_ms) > 5000) THEN 'ttl'
  WHEN s.size <> t.size THEN 'size' WHEN s.value <> t.value THEN 'value' END AS reason
 FROM s FULL JOIN t ON s.key = t.key)
SELECT reason, count(*) AS n FROM d WHERE reason IS NOT NULL GROUP BY reason""")
def reconcile_full(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.pass_summary(reconcile.first_differences(*keyspaces(spark, sf)))


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


DIFFS = f"""WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}),
d AS (SELECT coalesce(s.key, t.key) AS key, t.type AS t_type, CASE WHEN t.key IS NULL THEN 'missing_on_target' WHEN s.key IS NULL THEN 'extra_on_target'
  WHEN s.type <> t.type THEN 'type'
  WHEN (s.ttl_ms > 0) <> (t.ttl_ms > 0) OR (s.ttl_ms > 0 AND abs(s.ttl_ms - t.ttl_ms) > 5000) THEN 'ttl'
  WHEN s.size <> t.size THEN 'size' WHEN s.value <> t.value THEN 'value' END AS reason
 FROM s FULL JOIN t ON s.key = t.key)"""


@query("reconcile_examples", DIFFS + " SELECT key, reason FROM d WHERE reason IS NOT NULL ORDER BY key, reason LIMIT 100")
def reconcile_examples(spark, sf):
    return reconcile.examples(reconcile.first_differences(*keyspaces(spark, sf)), 100)


@query("reconcile_spared", DIFFS + """ SELECT reason, count(*) AS n FROM d
WHERE reason IS NOT NULL AND NOT (reason = 'extra_on_target' AND key LIKE 'order:x1%') GROUP BY reason""")
def reconcile_spared(spark, sf):
    spare = keys.allows_key(F.col("key"), only=["order:x1"])
    return reconcile.pass_summary(reconcile.first_differences(*keyspaces(spark, sf), spare=spare))


@query("repair_then_clean", SOURCE_KV)
def repair_then_clean(spark, sf):
    """The target after its differences have been repaired: the source."""
    src, tgt = keyspaces(spark, sf)
    return sync.apply_repairs(reconcile.first_differences(src, tgt), src, tgt)


@query("scan_filtered", f"""WITH s AS ({SOURCE_KV}) SELECT key, type, ttl_ms FROM s
WHERE key LIKE 'order:%7' AND key NOT LIKE 'order:1%' AND type IN ('hash', 'zset') AND NOT (ttl_ms >= 0 AND ttl_ms < 3650000)""")
def scan_filtered(spark, sf):
    src, _ = keyspaces(spark, sf)
    entries, _, _ = readers.scan_keys(src, "order:*7", ["HASH", "zset"], deny=["order:1"], skip_volatile=True, volatile_ms=3650000)
    return entries.select("key", "type", "ttl_ms")


@query("type_skips", f"WITH s AS ({SOURCE_KV}) SELECT type, count(*) AS n FROM s WHERE key LIKE 'order:_2%' AND type NOT IN ('hash', 'list') GROUP BY type")
def type_skips(spark, sf):
    return readers.scan_keys(keyspaces(spark, sf)[0], "order:?2*", ["hash", "list"])[2]


@query("type_counts", f"WITH t AS ({TARGET_KV}) SELECT type, count(*) AS n FROM t GROUP BY type")
def type_counts(spark, sf):
    return keyspaces(spark, sf)[1].groupBy("type").agg(F.count("*").alias("n"))


@query("key_sample", f"WITH s AS ({SOURCE_KV}) SELECT key FROM s ORDER BY md5('seed' || key), key LIMIT 500")
def key_sample(spark, sf):
    return readers.sample_keys(keyspaces(spark, sf)[0].select("key"), 500, "seed")


@query("head_keys", f"WITH s AS ({SOURCE_KV}) SELECT key, type FROM s ORDER BY key LIMIT 250")
def head_keys(spark, sf):
    return readers.head_keys(keyspaces(spark, sf)[0].select("key", "type"), 250)


NAMES = keys.KeyNames.parse("user:=account:,user:admin:=staff:", "app", ":")
NAMED = """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'user:' WHEN 1 THEN 'user:admin:' WHEN 2 THEN 'account:' ELSE 'order:' END || CAST(c_custkey AS VARCHAR) AS key FROM customer"""
MAPPED = f"""n AS ({NAMED}), m AS (SELECT key, CASE WHEN key LIKE 'user:admin:%' THEN 'app:staff:' || substr(key, 12)
 WHEN key LIKE 'user:%' THEN 'app:account:' || substr(key, 6) WHEN key LIKE 'account:%' OR key LIKE 'staff:%' THEN NULL ELSE 'app:' || key END AS target FROM n)"""


def named_keys(spark, sf):
    prefix = F.element_at(F.array(*map(F.lit, ("user:", "user:admin:", "account:", "order:"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    return _t(spark, sf, "customer").select(F.concat(prefix, F.col("c_custkey").cast("string")).alias("key"))


@query("map_forward", f"WITH {MAPPED} SELECT key, target FROM m")
def map_forward(spark, sf):
    return named_keys(spark, sf).select("key", NAMES.to_target(F.col("key")).alias("target"))


@query("map_inverse", f"WITH {MAPPED} SELECT target, key AS source FROM m WHERE target IS NOT NULL UNION ALL SELECT key, NULL FROM m WHERE key LIKE 'order:%'")
def map_inverse(spark, sf):
    k = named_keys(spark, sf)
    t = k.select(NAMES.to_target(F.col("key")).alias("target")).filter("target is not null").unionByName(k.filter("key like 'order:%'").select(F.col("key").alias("target")))
    return t.select("target", NAMES.to_source(F.col("target")).alias("source"))


@query("map_collisions", f"WITH {MAPPED} SELECT key, 'no target name: a renamed key could land on it' AS reason FROM m WHERE target IS NULL")
def map_collisions(spark, sf):
    return sync.mapped(named_keys(spark, sf), NAMES)[1]


@query("ttl_effective", f"""WITH s AS ({SOURCE_KV}) SELECT key, CASE WHEN ttl_ms > 0 THEN ttl_ms END AS preserved, CAST(NULL AS BIGINT) AS stripped,
 CASE WHEN ttl_ms > 0 THEN ttl_ms ELSE 0 END + 600000 AS reset, CASE WHEN ttl_ms > 0 THEN greatest(1, ttl_ms - 3650000) ELSE ttl_ms END AS aged FROM s""")
def ttl_effective(spark, sf):
    ttl, ms = F.col("ttl_ms"), lambda n: F.lit(n).cast("long")
    return keyspaces(spark, sf)[0].select(
        "key", keys.effective_ttl(ttl).alias("preserved"), keys.effective_ttl(ttl, "STRIP").alias("stripped"),
        keys.effective_ttl(ttl, "RESET", 600000).alias("reset"), keys.remaining_ttl(ttl, ms(1000), ms(3651000)).alias("aged"),
    )


@query("existence_router", f"""WITH {MAPPED}, s AS (SELECT key FROM n WHERE c_custkey % 3 = 0)
SELECT m.target AS key, m.key AS source_key, CASE WHEN m.key LIKE 'order:%' THEN 'filtered' WHEN s.key IS NOT NULL THEN 'exists' ELSE 'missing' END AS route
FROM m LEFT JOIN s ON m.key = s.key WHERE target IS NOT NULL""")
def existence_router(spark, sf):
    k = named_keys(spark, sf)
    there = k.filter(F.regexp_extract("key", r"(\d+)$", 1).cast("long") % 3 == 0)
    targets = k.select(NAMES.to_target(F.col("key")).alias("key")).filter("key is not null")
    return sync.existence(targets, there, NAMES, deny=["order:"])


@query("reconcile_renamed", f"""WITH {MAPPED}, s AS (SELECT target AS key FROM m WHERE target IS NOT NULL),
t AS (SELECT target AS key FROM m WHERE target IS NOT NULL AND substr(key, length(key)) <> '7' UNION ALL SELECT 'app:account:none' )
SELECT CASE WHEN t.key IS NULL THEN 'missing_on_target' ELSE 'extra_on_target' END AS reason, count(*) AS n
FROM s FULL JOIN t ON s.key = t.key WHERE s.key IS NULL OR t.key IS NULL GROUP BY 1""")
def reconcile_renamed(spark, sf):
    k = named_keys(spark, sf).withColumns({"type": F.lit("hash"), "ttl_ms": F.lit(-1), "size": F.lit(1), "value": F.lit("v")})
    src, _ = sync.mapped(k, NAMES)
    left, _ = sync.mapped(k.filter(~F.col("key").endswith("7")), NAMES)
    return reconcile.pass_summary(reconcile.first_differences(src, left.unionByName(k.limit(1).withColumn("key", F.lit("app:account:none")))))


UPSERT = f"""WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV})"""


@query("upsert_overwrite", UPSERT + " SELECT * FROM s UNION ALL SELECT t.* FROM t WHERE key NOT IN (SELECT key FROM s)")
def upsert_overwrite(spark, sf):
    src, tgt = keyspaces(spark, sf)
    return sync.upsert(src, tgt)[0]


@query("upsert_skip", UPSERT + " SELECT t.* FROM t UNION ALL SELECT s.* FROM s WHERE key NOT IN (SELECT key FROM t)")
def upsert_skip(spark, sf):
    src, tgt = keyspaces(spark, sf)
    return sync.upsert(src, tgt, "SKIP")[0]


@query("upsert_fail", UPSERT + """ SELECT s.key, CASE WHEN t.key IS NULL THEN 'success' ELSE 'failure' END AS outcome,
 CASE WHEN t.key IS NOT NULL THEN 'the key already exists on the target and conflict-strategy is FAIL' END AS reason FROM s LEFT JOIN t ON s.key = t.key""")
def upsert_fail(spark, sf):
    src, tgt = keyspaces(spark, sf)
    return sync.upsert(src, tgt, "FAIL")[1]


@query("latest_per_key", """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(spark, sf):
    return sync.latest_per_key(_t(spark, sf, "events"), ["ts", "event_id"], "user_id")[0].select("user_id", "event_id", "event_type")


@query("records_hash", """SELECT 'cust:' || CAST(c_custkey AS VARCHAR) AS key, 'hash' AS type, 3 AS n_fields, CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || c_mktsegment AS flat FROM customer""")
def records_hash(spark, sf):
    good, _ = readers.to_key_records(_t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "cust:${c_custkey}")
    return good.select("key", "type", F.size("value").alias("n_fields"), F.array_join(F.transform("value", lambda f: f["value"]), "|").alias("flat"))


@query("records_json", """SELECT 'part:' || p_brand || ':' || CAST(p_partkey AS VARCHAR) AS key, 'json' AS type, p_name, CAST(p_size AS BIGINT) AS p_size FROM part""")
def records_json(spark, sf):
    good, _ = readers.to_key_records(_t(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size"), "part:${p_brand}:${p_partkey}", "json")
    doc = F.from_json("value", "p_name string, p_size long")
    return good.select("key", "type", doc["p_name"].alias("p_name"), doc["p_size"].alias("p_size"))


@query("incremental_cursor", "SELECT CAST(max(o_orderkey) AS VARCHAR) AS cursor FROM orders WHERE o_orderkey > 1000")
def incremental_cursor(spark, sf):
    _t(spark, sf, "orders").createOrReplaceTempView("_keyloom_orders")
    return readers.read_incremental(spark, "select * from _keyloom_orders where o_orderkey > ${cursor} order by o_orderkey", "o_orderkey", "1000")[1]


@query("jsonl_roundtrip", """SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS key, 'string' AS type, -1 AS ttl_ms, text AS value FROM documents WHERE text IS NOT NULL""")
def jsonl_roundtrip(spark, sf):
    docs = _t(spark, sf, "documents").filter("text is not null")
    key = F.encode(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")), "UTF-8")
    records = docs.select(key.alias("key"), F.lit("string").alias("type"), F.lit(-1).cast("long").alias("ttl_ms"), F.encode("text", "UTF-8").alias("value"))
    good, _ = values.from_envelope(values.to_envelope(records))
    return good.select(F.decode("key", "UTF-8").alias("key"), "type", "ttl_ms", F.decode("value", "UTF-8").alias("value"))


@query("dead_letter_history", """WITH f AS (SELECT 'user:' || CAST(user_id AS VARCHAR) AS key, ts, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
 FROM events WHERE event_type IN ('error', 'view'))
SELECT key, max(CASE WHEN rn = 1 THEN CASE event_type WHEN 'view' THEN 'no reason recorded' ELSE event_type END END) AS reason, least(count(*) - 1, 20) AS n_history,
 coalesce(string_agg(CASE event_type WHEN 'view' THEN 'no reason recorded' ELSE event_type END, ',' ORDER BY rn) FILTER (rn BETWEEN 2 AND 21), '') AS history FROM f GROUP BY key""")
def dead_letter_history(spark, sf):
    e = _t(spark, sf, "events").filter("event_type in ('error', 'view')")
    reason = F.when(F.col("event_type") != "view", F.col("event_type"))
    f = e.select(F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("key"), F.lit(0).alias("chunk"), reason.alias("reason"), F.col("ts").alias("failed_at"), F.col("event_id").alias("seq"))
    d = sync.dead_letters(f)
    return d.select("key", "reason", F.size("history").cast("long").alias("n_history"), F.array_join(F.transform("history", lambda h: h["reason"]), ",").alias("history"))


LISTS = """SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS items FROM lineitem GROUP BY l_orderkey"""


def order_lists(spark, sf):
    item = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    lists = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(item.alias("l"))
    return lists.select(F.col("l_orderkey").cast("string").alias("key"), F.lit("list").alias("type"), F.lit(60000).cast("long").alias("ttl_ms"), F.col("l.l_partkey").cast("array<string>").alias("items"))


@query("chunk_counts", f"WITH l AS ({LISTS}), c AS (SELECT unnest(range(CAST(greatest(1, ceil(len(items) / 3.0)) AS BIGINT))) AS chunk FROM l) SELECT chunk, count(*) AS n FROM c GROUP BY chunk")
def chunk_counts(spark, sf):
    return values.split_chunks(order_lists(spark, sf), "items", {"list": 3}).groupBy(F.col("chunk").cast("long").alias("chunk")).agg(F.count("*").alias("n"))


@query("chunk_roundtrip", f"WITH l AS ({LISTS}) SELECT CAST(l_orderkey AS VARCHAR) AS key, array_to_string(items, ',') AS items FROM l")
def chunk_roundtrip(spark, sf):
    done, _, _ = values.join_chunks(values.split_chunks(order_lists(spark, sf), "items", {"list": 3}), "items")
    return done.select("key", F.array_join("items", ",").alias("items"))


@query("render_commands", f"""WITH l AS ({LISTS}) SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(2 + ceil(len(items) / 2.0) AS BIGINT) AS commands, CAST(1 + 1 + 2 * ceil(len(items) / 2.0) + len(items) + 3 AS BIGINT) AS words FROM l""")
def render_commands(spark, sf):
    c = values.render_commands(order_lists(spark, sf), chunk=2)
    return c.groupBy("key").agg(F.count("*").alias("commands"), F.sum(F.size("argv")).cast("long").alias("words"))


@query("topk_plan", """WITH i AS (SELECT CAST(user_id AS VARCHAR) AS item, count(*) * 10000 AS c FROM events GROUP BY user_id),
s AS (SELECT item, c, unnest(range(1, CAST(ceil(c / 100000.0) AS BIGINT) + 1)) AS step FROM i),
p AS (SELECT item, step, least(100000, c - (step - 1) * 100000) AS incr, row_number() OVER (ORDER BY item, step) AS rn FROM s)
SELECT CAST(floor((rn - 1) / 900) AS BIGINT) AS call, count(*) AS pairs, CAST(sum(incr) AS BIGINT) AS total FROM p GROUP BY 1""")
def topk_plan(spark, sf):
    items = _t(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("item")).agg((F.count("*") * 10000).alias("count")).withColumn("key", F.lit("top"))
    return modules.topk_plan(items).groupBy("call").agg(F.count("*").alias("pairs"), F.sum("incr").alias("total"))


@query("topk_items", "SELECT l_partkey AS item, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, item LIMIT 50")
def topk_items(spark, sf):
    return modules.topk(_t(spark, sf, "lineitem").select(F.col("l_partkey").alias("item")), 50)


@query("batch_caps", f"""WITH s AS ({SOURCE_KV}), b AS (SELECT key, CASE WHEN type = 'hash' THEN 'hash' ELSE 'shared' END AS bucket, CASE WHEN type = 'hash' THEN 20 ELSE 50 END AS cap FROM s),
n AS (SELECT bucket, CAST(ceil(row_number() OVER (PARTITION BY bucket ORDER BY key) / CAST(cap AS DOUBLE)) AS BIGINT) AS batch FROM b)
SELECT bucket, batch, count(*) AS n FROM n GROUP BY bucket, batch""")
def batch_caps(spark, sf):
    return sync.assign_batches(keyspaces(spark, sf)[0], ["key"], 50, {"hash": 20}).groupBy("bucket", "batch").agg(F.count("*").alias("n"))


EVENT_SQL = """SELECT event_id, 'user:' || CAST(user_id AS VARCHAR) AS key, user_id, CASE event_type WHEN 'error' THEN 'deleted' WHEN 'signup' THEN 'deleted' WHEN 'purchase' THEN 'expired' ELSE 'changed' END AS route, ts FROM events"""


def event_stream(spark, sf):
    op = F.create_map(*(F.lit(x) for p in {"error": "del", "view": "hset", "click": "set", "purchase": "expired", "signup": "rename_from"}.items() for x in p))
    channel = F.concat(F.lit("__keyevent@"), (F.col("user_id") % 2).cast("string"), F.lit("__:"), F.element_at(op, F.col("event_type")))
    return _t(spark, sf, "events").select("event_id", channel.alias("channel"), F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("message"), "ts")


@query("event_routes", f"WITH e AS ({EVENT_SQL}) SELECT CAST(user_id % 2 AS INTEGER) AS db, CASE WHEN key LIKE 'user:13%' THEN 'filtered' ELSE route END AS route, count(*) AS n FROM e GROUP BY 1, 2")
def event_routes(spark, sf):
    return sync.route_events(event_stream(spark, sf), deny=["user:13"]).groupBy("db", "route").agg(F.count("*").alias("n"))


@query("changed_keys", f"WITH e AS ({EVENT_SQL}) SELECT DISTINCT key FROM e WHERE route = 'changed'")
def changed_keys(spark, sf):
    return sync.route_events(event_stream(spark, sf)).filter("route = 'changed'").select("key").distinct()


@query("live_apply", f"""WITH e AS ({EVENT_SQL}), c AS (SELECT DISTINCT key FROM e WHERE route = 'changed' AND user_id % 2 = 1), s AS ({NAMED.replace("customer", "customer WHERE c_custkey % 5 <> 0")}),
src AS (SELECT DISTINCT 'user:' || CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey % 5 <> 0), old AS (SELECT 'user:' || CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0)
SELECT key, 'new' AS value FROM src WHERE key IN (SELECT key FROM c) UNION ALL SELECT key, 'old' FROM old WHERE key NOT IN (SELECT key FROM c)""")
def live_apply(spark, sf):
    changed = sync.route_events(event_stream(spark, sf)).filter("route = 'changed' and db = 1").select("key")
    c = _t(spark, sf, "customer").select("c_custkey", F.concat(F.lit("user:"), F.col("c_custkey").cast("string")).alias("key"), F.lit("hash").alias("type"))
    src = c.filter("c_custkey % 5 <> 0").select("key", "type", F.lit("new").alias("value"))
    old = c.filter("c_custkey % 2 = 0 or c_custkey % 5 = 0").select("key", "type", F.lit("old").alias("value"))
    return live.apply_batch(changed, src, old)[0].select("key", "value")


def command_log(spark, sf):
    """Events as a replication log: view SET, click MSET of two keys, purchase SELECT, signup an unknown command, error PUBLISH."""
    e, key = _t(spark, sf, "events"), F.concat(F.lit("user:"), F.col("user_id").cast("string"))
    kind, word = F.col("event_type"), F.lit
    argv = (
        F.when(kind == "view", F.array(word("SET"), key, word("v"))).when(kind == "click", F.array(word("MSET"), key, word("1"), F.concat(key, word(":b")), word("2")))
        .when(kind == "purchase", F.array(word("select"), (F.col("user_id") % 2).cast("string"))).when(kind == "signup", F.array(word("XTHING"), key))
        .otherwise(F.array(word("PUBLISH"), word("c"), word("m")))
    )
    log = e.select((F.col("user_id") % 3).cast("string").alias("shard"), F.lit(1).cast("long").alias("generation"), F.col("event_id").alias("offset_after"), argv.alias("argv"))
    table = [("set", 1, 1, 1, False), ("mset", 1, -1, 2, False), ("select", 0, 0, 0, False), ("publish", 0, 0, 0, False), ("xgroup|create", 2, 2, 1, False)]
    return log, spark.createDataFrame(table, "name string, first int, last int, step int, movable boolean")


LOG_SQL = """l AS (SELECT event_id, user_id, user_id % 3 AS shard, event_type, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN user_id % 2 END IGNORE NULLS)
 OVER (PARTITION BY user_id % 3 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS db FROM events)"""


@query("command_databases", f"WITH {LOG_SQL} SELECT CAST(shard AS VARCHAR) AS shard, CAST(db AS INTEGER) AS db, count(*) AS n FROM l GROUP BY 1, 2")
def command_databases(spark, sf):
    return sync.with_database(command_log(spark, sf)[0]).groupBy("shard", "db").agg(F.count("*").alias("n"))


@query("command_keys", f"""WITH {LOG_SQL}, k AS (SELECT event_id, 'user:' || CAST(user_id AS VARCHAR) AS key FROM l WHERE db = 0 AND event_type IN ('view', 'click')
 UNION ALL SELECT event_id, 'user:' || CAST(user_id AS VARCHAR) || ':b' FROM l WHERE db = 0 AND event_type = 'click') SELECT key, max(event_id) AS "offset" FROM k GROUP BY key""")
def command_keys(spark, sf):
    return sync.changed_keys(*command_log(spark, sf))[0]


@query("command_unresolved", f"WITH {LOG_SQL} SELECT event_id AS offset_after FROM l WHERE db = 0 AND event_type = 'signup'")
def command_unresolved(spark, sf):
    return sync.changed_keys(*command_log(spark, sf))[1].select("offset_after")


def flush_log(spark, sf):
    e, kind = _t(spark, sf, "events"), F.col("event_type")
    n = (F.col("user_id") % 3).cast("string")
    argv = (
        F.when(kind == "view", F.array(F.lit("FLUSHDB"))).when(kind == "click", F.array(F.lit("swapdb"), F.lit("0"), n)).when(kind == "purchase", F.array(F.lit("SELECT"), n))
        .when(kind == "signup", F.array(F.lit("MOVE"), F.concat(F.lit("k"), F.col("event_id").cast("string")), n)).otherwise(F.array(F.lit("FLUSHALL")))
    )
    return e.select(F.lit("0").alias("shard"), F.lit(1).alias("generation"), F.col("event_id").alias("offset_after"), argv.alias("argv"))


FLUSH_SQL = """l AS (SELECT event_id, event_type, user_id % 3 AS arg, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN user_id % 3 END IGNORE NULLS)
 OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS db FROM events)"""


@query("flushes", f"WITH {FLUSH_SQL} SELECT event_id AS offset_after FROM l WHERE event_type = 'error' OR (event_type = 'view' AND db = 1) OR (event_type = 'click' AND arg = 1)")
def flushes(spark, sf):
    return sync.flushes(flush_log(spark, sf), 1).select("offset_after")


@query("arrivals", f"WITH {FLUSH_SQL} SELECT event_id AS offset_after, 'k' || CAST(event_id AS VARCHAR) AS key FROM l WHERE event_type = 'signup' AND arg = 1 AND db <> 1")
def arrivals(spark, sf):
    return sync.arrivals(flush_log(spark, sf), 1).select("offset_after", "key")


@query("slot_gaps", """WITH c AS (SELECT DISTINCT o_orderkey % 16384 AS slot FROM orders WHERE o_orderkey % 97 <> 0), g AS (SELECT s.range AS slot FROM range(16384) s WHERE s.range NOT IN (SELECT slot FROM c)),
i AS (SELECT slot, slot - row_number() OVER (ORDER BY slot) AS island FROM g) SELECT min(slot) AS start, max(slot) AS "end" FROM i GROUP BY island""")
def slot_gaps(spark, sf):
    held = _t(spark, sf, "orders").filter("o_orderkey % 97 <> 0").select((F.col("o_orderkey") % 16384).alias("slot"))
    return topology.slot_gaps(topology.to_ranges(held).withColumn("node_id", F.lit(0)))


@query("slot_owner_counts", """SELECT n_nationkey AS node_id, count(*) AS n FROM orders JOIN nation ON o_orderkey % 16384 BETWEEN n_nationkey * 700 AND n_nationkey * 700 + 649 GROUP BY 1""")
def slot_owner_counts(spark, sf):
    ranges = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("node_id"), (F.col("n_nationkey") * 700).alias("start"), (F.col("n_nationkey") * 700 + 649).alias("end"))
    k = _t(spark, sf, "orders").select((F.col("o_orderkey") % 16384).alias("slot"))
    return topology.key_owner(k, ranges).filter("node_id is not null").groupBy("node_id").agg(F.count("*").alias("n"))


@query("topology_drift", """WITH e AS (SELECT DISTINCT date_trunc('day', ts) AS snapshot_id, user_id % 20 AS node_id, user_id // 20 AS slot FROM events WHERE user_id % 20 < 12 OR event_type = 'error'),
s AS (SELECT snapshot_id, node_id, list(DISTINCT slot ORDER BY slot) AS slots FROM e GROUP BY 1, 2), n AS (SELECT snapshot_id, row_number() OVER (ORDER BY snapshot_id) AS seq FROM (SELECT DISTINCT snapshot_id FROM s)),
x AS (SELECT seq, node_id, slots FROM s JOIN n USING (snapshot_id)), m AS (SELECT coalesce(a.seq + 1, b.seq) AS pos, a.slots AS b, b.slots AS c FROM x a FULL JOIN x b ON a.seq + 1 = b.seq AND a.node_id = b.node_id),
f AS (SELECT pos, count(*) FILTER (b IS NULL) AS joined, count(*) FILTER (c IS NULL) AS departed, count(*) FILTER (b IS NOT NULL AND c IS NOT NULL AND b <> c) AS reassigned FROM m GROUP BY pos)
SELECT 0 AS run_id, snapshot_id, joined, departed, reassigned, CASE WHEN joined > 0 THEN 'CRITICAL' WHEN departed + reassigned > 0 THEN 'ADVISORY' ELSE 'NONE' END AS severity FROM f JOIN n ON f.pos = n.seq WHERE pos > 1""")
def topology_drift(spark, sf):
    e = _t(spark, sf, "events").filter("user_id % 20 < 12 or event_type = 'error'")
    s = e.groupBy(F.date_trunc("day", "ts").alias("snapshot_id"), (F.col("user_id") % 20).alias("node_id")).agg(F.collect_set(F.floor(F.col("user_id") / 20)).alias("slots"))
    return topology.drift(s.withColumn("run_id", F.lit(0)))


@query("outages", """WITH l AS (SELECT user_id % 10 AS run_id, ts, event_id, CASE event_type WHEN 'error' THEN 'down' ELSE 'up' END AS state FROM events WHERE event_type IN ('error', 'click')),
w AS (SELECT *, lag(state) OVER (PARTITION BY run_id ORDER BY ts, event_id) AS was FROM l), c AS (SELECT * FROM w WHERE was IS NULL OR was <> state),
u AS (SELECT *, lead(ts) OVER (PARTITION BY run_id ORDER BY ts, event_id) AS up_at FROM c)
SELECT run_id, count(*) AS n, count(up_at) AS closed FROM u WHERE state = 'down' GROUP BY run_id""")
def outages(spark, sf):
    e = _t(spark, sf, "events").filter("event_type in ('error', 'click')")
    log = e.select((F.col("user_id") % 10).alias("run_id"), "ts", F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", "down").otherwise("up").alias("state"))
    return runs.outages(log).groupBy("run_id").agg(F.count("*").alias("n"), F.count("up_at").alias("closed"))


SIZES = """s AS (SELECT CAST(0 AS BIGINT) AS run_id, date_trunc('hour', ts) AS ts, count(DISTINCT user_id) AS size FROM events GROUP BY 2)"""


def hourly(spark, sf):
    return _t(spark, sf, "events").groupBy(F.lit(0).cast("long").alias("run_id"), F.date_trunc("hour", "ts").alias("ts")).agg(F.countDistinct("user_id").alias("size"))


@query("size_drops", f"""WITH {SIZES}, p AS (SELECT ts, size, lag(size) OVER (ORDER BY ts) AS previous FROM s) SELECT ts, size, previous FROM p WHERE previous > 0 AND size <= (previous * 80) // 100""")
def size_drops(spark, sf):
    return runs.size_drops(hourly(spark, sf), 20).select("ts", "size", "previous")


@query("progress", f"""WITH {SIZES}, g AS (SELECT ts, size, size - lag(size) OVER (ORDER BY ts) AS gained FROM s), m AS (SELECT *, sum(CASE WHEN coalesce(gained, 1) <> 0 THEN 1 ELSE 0 END) OVER (ORDER BY ts) AS m FROM g),
q AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY ts) - 1 AS quiet FROM m)
SELECT ts, size * 100 // 20 AS percent, gained, CAST(quiet AS BIGINT) AS quiet, CASE WHEN size >= 20 THEN 'caught_up' WHEN quiet >= 1 THEN 'stalled' ELSE 'copying' END AS state FROM q""")
def progress(spark, sf):
    s = hourly(spark, sf).select("run_id", "ts", F.lit(20).cast("long").alias("source"), F.col("size").alias("target"))
    return runs.progress(s, 1).select("ts", "percent", "gained", F.col("quiet").cast("long").alias("quiet"), "state")


@query("lag_report", """WITH m AS (SELECT user_id % 7 AS shard, max(event_id) AS master FROM events GROUP BY 1), p AS (SELECT user_id % 7 AS shard, max(event_id) AS pos FROM events WHERE event_type <> 'view' GROUP BY 1),
n AS (SELECT user_id % 7 AS shard, count(*) AS pending FROM events WHERE event_type = 'signup' AND user_id % 7 < 3 GROUP BY 1)
SELECT m.shard, greatest(0, master - pos) AS bytes_behind, CAST(CASE WHEN master <= pos AND coalesce(pending, 0) = 0 THEN 0 ELSE 30 END AS BIGINT) AS seconds_behind, coalesce(pending, 0) AS pending, (master <= pos AND coalesce(pending, 0) = 0) AS caught_up FROM m LEFT JOIN p USING (shard) LEFT JOIN n USING (shard)""")
def lag_report(spark, sf):
    e = _t(spark, sf, "events").withColumn("shard", F.col("user_id") % 7)
    masters = e.groupBy("shard").agg(F.max("event_id").alias("master_offset"), F.lit(130).cast("long").alias("now"))
    positions = e.filter("event_type <> 'view'").groupBy("shard").agg(F.max("event_id").alias("offset"), F.lit(100).cast("long").alias("caught_up_at"))
    pend = e.filter("event_type = 'signup' and shard < 3").select("shard", F.col("event_id").alias("key"))
    return runs.lag_report(positions, masters, pend)


@query("cutover_verdict", """WITH p AS (SELECT o_custkey AS run_id, max_by(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey ELSE 0 END, o_orderkey) AS clean FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1)
SELECT c_custkey AS run_id, CASE WHEN c_custkey % 5 = 0 OR (c_custkey % 7 > 5) THEN 'LAGGING' WHEN NOT coalesce(clean > 0 AND clean >= 100, false) THEN 'NOT_SAFE' WHEN c_custkey % 4 = 1 THEN 'UNREVIEWED' ELSE 'SAFE' END AS verdict
FROM customer LEFT JOIN p ON run_id = c_custkey""")
def cutover_verdict(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    passes = o.select(F.col("o_custkey").alias("run_id"), F.when(k % 2 == 0, "FULL").otherwise("SAMPLE").alias("mode"), k.alias("started_at"), k.alias("finished_at"), F.when(k % 3 == 0, 5).otherwise(0).alias("differences"))
    n = F.col("c_custkey")
    facts = _t(spark, sf, "customer").select(n.alias("run_id"), F.lit(False).alias("caught_up"), (n % 7).alias("lag"), F.when(n % 5 == 0, 3).otherwise(0).alias("queued"), F.when(n % 4 == 1, 2).otherwise(0).alias("pending"), F.lit(100).alias("since"))
    return runs.cutover_verdict(facts.join(runs.clean_since(passes), "run_id", "left"))


def _validate(mode, sql):
    def f(spark, sf):
        return sync.validate(*keyspaces(spark, sf), mode).groupBy("result").agg(F.count("*").alias("n"))

    query(f"validate_{mode.lower()}", f"WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}), r AS (SELECT CASE WHEN t.key IS NULL THEN 'missing' {sql} ELSE 'ok' END AS result FROM s LEFT JOIN t ON s.key = t.key) SELECT result, count(*) AS n FROM r GROUP BY result")(f)


_validate("EXISTENCE", "")
_validate("TYPE", "WHEN s.type <> t.type THEN 'type'")
_validate("FULL_VALUE", "WHEN s.type <> t.type THEN 'type' WHEN s.value <> t.value THEN 'value'")
_validate("TTL_DELTA", "WHEN s.type <> t.type THEN 'type' WHEN abs(s.ttl_ms - t.ttl_ms) > 5000 THEN 'ttl'")


@query("validation_summary", f"""WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}), r AS (SELECT CASE WHEN t.key IS NULL THEN 'missing' WHEN s.type <> t.type THEN 'type' WHEN s.value <> t.value THEN 'value' ELSE 'ok' END AS result FROM s LEFT JOIN t ON s.key = t.key)
SELECT count(*) AS checked, count(*) FILTER (result = 'ok') AS passed, count(*) FILTER (result <> 'ok') AS failed, count(*) FILTER (result = 'missing') AS missing, count(*) FILTER (result = 'type') AS type_mismatch, count(*) FILTER (result = 'value') AS value_mismatch FROM r""")
def validation_summary(spark, sf):
    return sync.validation_summary(sync.validate(*keyspaces(spark, sf)))


@query("module_dispositions", """WITH p AS (SELECT CASE p_partkey % 5 WHEN 0 THEN 'ReJSON-RL' WHEN 1 THEN 'MBbloom--' WHEN 2 THEN 'vectorset' WHEN 3 THEN 'TopK-TYPE' ELSE p_brand END AS type FROM part)
SELECT type, CASE type WHEN 'ReJSON-RL' THEN 'json_rebuild' WHEN 'TopK-TYPE' THEN 'topk_rebuild' WHEN 'vectorset' THEN 'not_supported' ELSE 'restore_only' END AS disposition, count(*) AS n FROM p GROUP BY 1, 2""")
def module_dispositions(spark, sf):
    kind = F.when(F.col("p_partkey") % 5 == 4, F.col("p_brand")).otherwise(F.try_element_at(F.array(*map(F.lit, ("ReJSON-RL", "MBbloom--", "vectorset", "TopK-TYPE"))), (F.col("p_partkey") % 5 + 1).cast("int")))
    t = _t(spark, sf, "part").select(kind.alias("type"))
    return t.groupBy("type", modules.disposition(F.col("type")).alias("disposition")).agg(F.count("*").alias("n"))


@query("restore_verdicts", f"""WITH s AS ({SOURCE_KV}), t AS ({TARGET_KV}), one AS (SELECT type, CAST(size % 2 AS VARCHAR) AS encoding, min(key) AS key FROM s GROUP BY 1, 2)
SELECT one.type, encoding, (t.key IS NOT NULL AND t.value = s.value) AS accepted, CASE WHEN t.key IS NULL THEN 'not there after the restore' WHEN t.value <> s.value THEN 'value differs after the restore' END AS reason
FROM one JOIN s ON s.key = one.key LEFT JOIN t ON t.key = one.key""")
def restore_verdicts(spark, sf):
    src, tgt = keyspaces(spark, sf)
    s = src.select("key", "type", (F.col("size") % 2).cast("string").alias("encoding"), F.col("value").alias("digest"))
    return modules.restore_verdicts(s, tgt.select("key", F.col("value").alias("digest"), F.lit(None).cast("string").alias("error")))


SEVERITIES = "CASE o_orderpriority WHEN '1-URGENT' THEN 'stop' WHEN '2-HIGH' THEN 'action' WHEN '3-MEDIUM' THEN 'check' ELSE 'info' END"


def order_findings(spark, sf, **more):
    severity = F.when(F.col("o_orderpriority") == "1-URGENT", "stop").when(F.col("o_orderpriority") == "2-HIGH", "action").when(F.col("o_orderpriority") == "3-MEDIUM", "check").otherwise("info")
    return _t(spark, sf, "orders").select(F.col("o_custkey").alias("source"), severity.alias("severity"), F.array((F.col("o_orderkey") % 3 + 1).cast("int")).alias("patterns"), *(c.alias(n) for n, c in more.items()))


STATUS_SQL = f"""f AS (SELECT o_custkey AS source, {SEVERITIES} AS severity, CAST(o_orderkey % 3 + 1 AS INTEGER) AS pattern FROM orders), e AS (SELECT c_custkey AS source, p.pattern FROM customer, (VALUES (1), (2), (3)) p(pattern)),
w AS (SELECT source, pattern, max(CASE severity WHEN 'stop' THEN 3 WHEN 'action' THEN 2 WHEN 'check' THEN 1 ELSE 0 END) AS rank FROM f GROUP BY 1, 2),
st AS (SELECT e.source, e.pattern, CASE coalesce(rank, 0) WHEN 3 THEN 'BLOCKED' WHEN 2 THEN 'READY AFTER WORK' WHEN 1 THEN 'READY AFTER CHECKS' ELSE 'READY' END AS status FROM e LEFT JOIN w ON e.source = w.source AND e.pattern = w.pattern)"""


@query("pattern_status", f"WITH {STATUS_SQL} SELECT source, CAST(pattern AS INTEGER) AS pattern, status FROM st")
def pattern_status(spark, sf):
    return assess.pattern_status(order_findings(spark, sf), sources=_t(spark, sf, "customer").select(F.col("c_custkey").alias("source")))


@query("recommendations", f"""WITH {STATUS_SQL}, o AS (SELECT *, CASE WHEN source % 2 = 0 THEN pattern ELSE (pattern + 1) % 3 END AS ord FROM st)
SELECT source, CAST(CASE WHEN count(*) FILTER (status = 'READY') > 0 THEN arg_min(pattern, ord) FILTER (status = 'READY') ELSE arg_min(pattern, ord) FILTER (status <> 'BLOCKED') END AS INTEGER) AS pattern, count(*) FILTER (status = 'READY') > 0 AS ready FROM o GROUP BY source""")
def recommendations(spark, sf):
    s = pattern_status(spark, sf).withColumn("cache_like", F.col("source") % 2 == 0)
    return assess.recommend(s)


@query("missing_commands", """SELECT DISTINCT l_suppkey % 50 AS source, 'cmd' || CAST(l_partkey % 200 AS VARCHAR) AS command FROM lineitem WHERE l_partkey % 200 NOT IN (SELECT p_partkey % 150 FROM part) AND l_partkey % 200 <> 177""")
def missing_commands(spark, sf):
    name = lambda c: F.concat(F.lit("cmd"), c.cast("string")).alias("command")
    used = _t(spark, sf, "lineitem").select((F.col("l_suppkey") % 50).alias("source"), name(F.col("l_partkey") % 200)).distinct()
    return assess.missing_commands(used, _t(spark, sf, "part").select(name(F.col("p_partkey") % 150)), spark.createDataFrame([("cmd177",)], "command string"))


@query("command_calls", "SELECT l_suppkey AS source, l_returnflag AS command, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS calls FROM lineitem GROUP BY 1, 2")
def command_calls(spark, sf):
    stat = F.concat(F.lit("calls="), F.col("l_quantity").cast("long").cast("string"), F.lit(",usec=12"))
    return assess.command_calls(_t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_returnflag").alias("command"), stat.alias("stat")))


@query("format_ranges", """SELECT s_suppkey AS source, CASE WHEN s_suppkey % 9 >= 7 THEN 'c' WHEN s_suppkey % 9 >= 4 THEN 'b' WHEN s_suppkey % 9 >= 2 THEN 'a' END AS format FROM supplier""")
def format_ranges(spark, sf):
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("source"), F.lit("x").alias("family"), F.concat((F.col("s_suppkey") % 9).cast("string"), F.lit(".0.12")).alias("version"))
    r = spark.createDataFrame([("x", "2", "a"), ("x", "4.0.3", "b"), ("x", "7.0", "c")], "family string, from_version string, format string")
    return assess.format_for(s, r).select("source", "format")


@query("index_plan", """WITH d AS (SELECT p_brand AS "index", count(*) FILTER (p_size < 20) > 0 AS supported FROM part GROUP BY 1)
SELECT "index", n_name AS node, CASE WHEN NOT supported THEN 'unsupported' WHEN right("index", 1) = CAST(n_regionkey AS VARCHAR) THEN 'keep' ELSE 'create' END AS action FROM d, nation""")
def index_plan(spark, sf):
    p = _t(spark, sf, "part")
    fields = p.select(F.col("p_brand").alias("index"), F.col("p_partkey").alias("position"), F.col("p_name").alias("identifier"), F.col("p_name").alias("attribute"), F.when(F.col("p_size") < 20, "TAG").otherwise("OTHER").alias("kind"), F.array().cast("array<string>").alias("options"))
    nodes = _t(spark, sf, "nation").select(F.col("n_name").alias("node"), "n_regionkey")
    brands = p.select(F.col("p_brand").alias("index")).distinct()
    there = brands.withColumn("n_regionkey", F.right("index", F.lit(1)).cast("long")).join(nodes, "n_regionkey").select("index", "node")
    return indexes.plan_indexes(indexes.index_args(fields), there, nodes)


@query("slot_hash", """WITH k AS (SELECT 'order:' || CAST(o_orderkey AS VARCHAR) AS k FROM orders),
c AS (SELECT list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
 lambda c, b: list_reduce(list_concat([xor(c, b * 256)], list_transform(range(8), lambda z: CAST(0 AS BIGINT))), lambda x, z: CASE WHEN x & 32768 <> 0 THEN xor(x * 2, 4129) & 65535 ELSE (x * 2) & 65535 END)) AS crc FROM k)
SELECT CAST(crc % 16384 AS BIGINT) AS slot, count(*) AS n FROM c GROUP BY 1""")
def slot_hash(spark, sf):
    """Keys of every slot; the tag in braces decides."""
    k = _t(spark, sf, "orders").select(keys.slot_of(F.concat(F.lit("{order:"), F.col("o_orderkey").cast("string"), F.lit("}:x"))).cast("long").alias("slot"))
    return k.groupBy("slot").agg(F.count("*").alias("n"))
