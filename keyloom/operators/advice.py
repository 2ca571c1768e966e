"""Advice on many sources in one job: rule tables compiled to a projection, findings, a status per pattern, a recommendation, a way to copy.

A rule says of which measures it speaks, which findings or reasons it gives, and how they read. All rules of
a table become one array expression over a source's row of measures, so the number of rules adds neither
joins nor passes. Patterns: 1 switches connections over, 2 loads a snapshot, 3 copies while writes go on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.operators import assess
from keyloom.operators.assess import version_tuple

ALL = (1, 2, 3)


@dataclass(frozen=True)
class Rule:
    """``text`` holds if every condition (measure, operator, value) does; ``{measure}`` in it stands for the measure's value.

    Operators: = <> < <= > >=, in, matches (a regular expression), has and lacks (of an array or the keys of a map),
    null (True or False), since and older (of versions). A null measure fulfils none of them but ``lacks`` and ``null``.
    """

    kind: str  # a severity, or the side that a reason is for
    text: str
    when: tuple[tuple[str, str, object], ...]
    patterns: tuple[int, ...] = ALL


def condition(measure: str, operator: str, value: object, shapes: dict[str, str]) -> Column:
    c = F.col(measure)
    if operator in ("has", "lacks"):
        names = F.map_keys(c) if shapes[measure] == "map" else c
        held = F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, value))) if isinstance(value, tuple) else F.array_contains(names, value), F.lit(False))
        return held if operator == "has" else ~held
    if operator in ("since", "older"):
        number = F.struct(*(F.lit(int(x)).alias(n) for x, n in zip(str(value).split("."), ("major", "minor", "patch"), strict=True)))
        return version_tuple(c) >= number if operator == "since" else version_tuple(c) < number
    plain = {
        "=": lambda: c == value, "<>": lambda: c != value, "<": lambda: c < value, "<=": lambda: c <= value, ">": lambda: c > value, ">=": lambda: c >= value,
        "in": lambda: c.isin(*value), "matches": lambda: c.rlike(value), "null": lambda: c.isNull() if value else c.isNotNull(),
    }
    return plain[operator]()


def printed(text: str) -> Column:
    parts = [F.coalesce(F.col(p[1:-1]).cast("string"), F.lit("none")) if p.startswith("{") else F.lit(p) for p in re.split(r"(\{\w+\})", text) if p]
    return F.concat(*parts)


def compiled(rules: list[Rule], measures: DataFrame) -> Column:
    """Array of (kind, text, patterns) of the rules that hold, in their order."""
    shapes = {f.name: f.dataType.typeName() for f in measures.schema.fields}
    each = []
    for r in rules:
        holds = F.lit(True)
        for measure, operator, value in r.when:
            holds = holds & F.coalesce(condition(measure, operator, value, shapes), F.lit(False))
        found = F.struct(F.lit(r.kind).alias("kind"), printed(r.text).alias("text"), F.array(*map(F.lit, r.patterns)).cast("array<int>").alias("patterns"))
        each.append(F.when(holds, found))
    return F.filter(F.array(*each), lambda x: x.isNotNull())


# Address parts of managed services, key types that every target holds, commands that set deadlines of hash fields.
MANAGED = r"cache\.amazonaws\.com|redis\.cache\.windows\.net|memorystore|redislabs\.com|redis-cloud\.com|upstash\.io"
NATIVE = ("string", "list", "set", "zset", "hash", "stream", "none")
FIELD_TTL = ("hexpire", "hpexpire", "hexpireat", "hpexpireat", "hpersist", "hsetex", "hgetex")
FILTERS = ("mbbloom--", "mbbloomcf", "cms-type")

FACT_RULES = [
    Rule("action", "the target does not say what it is", (("target_known", "=", False),)),
    Rule("check", "target version {target_version} is older than the rules", (("target_known", "=", True), ("target_version", "older", "2.0.0"))),
    Rule("check", "the target already holds {target_keys} keys", (("target_keys", ">", 0),), (2, 3)),
    Rule("check", "{family} {version} snapshot: load one for a test", (("format", "null", True), ("family", "=", "valkey"), ("version", "since", "9.0.0"), ("target_version", "since", "2.0.0")), (2,)),
    Rule("action", "{family} {version} snapshot needs a newer target", (("format", "null", True), ("family", "=", "valkey"), ("version", "since", "9.0.0"), ("target_version", "older", "2.0.0")), (2,)),
    Rule("check", "the snapshot format of {family} {version} is not known", (("format", "null", True), ("family", "=", "valkey"), ("version", "older", "9.0.0")), (2,)),
    Rule("check", "the snapshot format of {family} {version} is not known", (("format", "null", True), ("family", "<>", "valkey")), (2,)),
    Rule("info", "snapshots have format {format}", (("format", "null", False),), (2,)),
    Rule("info", "slots of the cluster are dropped on loading", (("format", "=", "12"), ("mode", "=", "cluster")), (2,)),
    Rule("info", "the source is like its predecessor", (("family", "=", "valkey"), ("version", "older", "8.0.0"))),
    Rule("check", "commands could not be compared", (("command_error", "=", True),)),
    Rule("action", "{functions} function libraries", (("functions", ">", 0),)),
    Rule("stop", "graphs have no place", (("modules", "has", "graph"),)),
    Rule("stop", "time series have no place", (("modules", "has", "timeseries"),)),
    Rule("check", "indexes have to be made again", (("modules", "has", ("search", "ft")),)),
    Rule("info", "documents are native", (("modules", "has", ("rejson", "redisjson")),)),
    Rule("check", "filters are native in part", (("modules", "has", ("bf", "redisbloom")),)),
    Rule("action", "{limited_users} users with key, channel or selector rules", (("limited_users", ">", 0),)),
    Rule("check", "users could not be read", (("limited_users", "=", 0), ("acl_error", "=", True))),
    Rule("check", "client-side caching: which mode the newer protocol's clients use", (("commands", "has", "client|tracking"), ("commands", "has", "hello"))),
    Rule("action", "client-side caching: clients seem to use the older protocol", (("commands", "has", "client|tracking"), ("commands", "lacks", "hello"))),
    Rule("action", "client-side caching needs a newer target", (("commands", "has", "client|tracking"), ("target_known", "=", True), ("target_version", "older", "1.14.0"))),
    Rule("check", "cluster clients need a cluster mode", (("mode", "=", "cluster"),)),
    Rule("check", "a change of the cluster may end a copy", (("mode", "=", "cluster"),), (3,)),
    Rule("check", "append-only persistence: snapshots bound what can be lost", (("aof", "=", True),)),
    Rule("check", "a managed service may close the replication log", (("managed", "=", True),), (3,)),
    Rule("check", "settings cannot be read", (("config_blocked", "=", True),), (3,)),
    Rule("action", "key events are '{notify}'", (("config_blocked", "=", False), ("events", "=", False)), (3,)),
    Rule("info", "flushes are no key events", (("source", "null", False),), (3,)),
    Rule("stop", "{used} bytes do not fit into {target_max}", (("target_max", ">", 0), ("room", "<", 0)), (2, 3)),
]

#: Reasons for copying through typed commands, for copying payloads, limits of the first, and things to do before.
REASON_RULES = [
    Rule("typed", "between targets of one kind filters can be copied, too", (("same_engine", "=", True),)),
    Rule("typed", "payloads of {family} {version} may be refused", (("family", "=", "redis"), ("version", "since", "8.0.0"))),
    Rule("typed", "payloads of {family} {version} may be refused", (("family", "=", "valkey"), ("version", "since", "9.0.0"))),
    Rule("typed", "hash fields have deadlines", (("commands", "has", FIELD_TTL), ("family", "=", "redis"), ("version", "since", "7.4.0"))),
    Rule("typed", "documents are made again", (("types", "has", "rejson-rl"),)),
    Rule("typed", "documents are made again", (("types", "lacks", "rejson-rl"), ("modules", "has", ("rejson", "redisjson")))),
    Rule("typed", "top lists are made again", (("types", "has", "topk-type"),)),
    Rule("typed", "{indexes} indexes are made again", (("indexes", ">", 0),)),
    Rule("typed", "durable data under writes: gaps are found and repaired", (("cache_like", "=", False),)),
    Rule("typed", "failovers and new shards are followed", (("mode", "=", "cluster"), ("closed", "=", False))),
    Rule("typed", "slots that move are read once they rest", (("mode", "=", "cluster"), ("closed", "=", True))),
    Rule("typed", "{keys} keys: a copy goes on where it stopped", (("keys", ">=", 5_000_000),)),
    Rule("typed", "filters are put aside and all else is copied", (("types", "has", FILTERS), ("same_engine", "=", False))),
    Rule("limit", "counts of top lists may differ", (("types", "has", "topk-type"),)),
    Rule("limit", "a dropped connection loses key events until a full pass", (("same_engine", "=", False),)),
    Rule("check", "filters reach the target in no way", (("types", "has", FILTERS), ("same_engine", "=", False))),
    Rule("check", "a full pass deletes what the target alone holds", (("target_keys", ">", 0),)),
    Rule("check", "the replication log may have another name", (("closed", "=", True), ("same_engine", "=", False))),
]
TYPE_RULES = {  # a type's severity, text and patterns; others are actions
    "rejson-rl": ("info", "documents are native", ALL), "topk-type": ("check", "top lists have to be made again", (2, 3)),
    "mbbloom--": ("check", "filters lack options", (2, 3)), "mbbloomcf": ("check", "cuckoo filters have to be tried", (2, 3)),
}


def measures(facts: DataFrame, commands: DataFrame, types: DataFrame, acls: DataFrame, formats: DataFrame) -> DataFrame:
    """One row a source: its facts, ``commands`` and ``types`` as maps to their numbers, users with limits, the snapshot format, and what follows from these.

    facts: source, family, version, mode, host, target_known, target_version, target_keys, target_max, used, keys, functions,
    modules, indexes, aof, notify, config_blocked, command_error, acl_error, policy, same_engine. commands and types
    (source, command or type, n) are counted by name, so a map has as many entries as there are names.
    """
    counted = lambda df, name: df.groupBy("source", F.lower(name).alias("_k")).agg(F.sum("n").alias("_n")).groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_n"))).alias(f"{name}s"))
    limits = F.col("rule").rlike(r"(^|\s)(~(?!\*(\s|$))|%[RWrw]+~|&(?!\*(\s|$)))|\(")
    users = acls.groupBy("source").agg(F.count_if(limits).alias("limited_users"))
    wide = assess.format_for(facts, formats)
    for more in (counted(commands, "command"), counted(types, "type"), users):
        wide = wide.join(more, "source", "left")
    wide = wide.withColumns({
        "commands": F.coalesce("commands", F.create_map().cast("map<string,bigint>")), "types": F.coalesce("types", F.create_map().cast("map<string,bigint>")),
        "limited_users": F.coalesce("limited_users", F.lit(0)), "managed": F.coalesce(F.lower("host").rlike(MANAGED), F.lit(False)), "room": F.col("target_max") - F.col("used"),
        "events": F.coalesce(F.contains("notify", F.lit("E")) & F.col("notify").rlike("A|(?=.*g)(?=.*\\$)(?=.*l)(?=.*s)(?=.*h)(?=.*z)(?=.*t)(?=.*x)(?=.*e)"), F.lit(False)),
        "cache_like": F.coalesce(F.col("policy").rlike("^(allkeys|volatile)"), F.lit(False)),
    })
    return wide.withColumn("closed", F.col("managed") | F.col("config_blocked"))


def findings(wide: DataFrame, commands: DataFrame, command_rules: DataFrame, target_commands: DataFrame, containers: list[str] = (), rules: list[Rule] = FACT_RULES, type_rules: dict = TYPE_RULES) -> DataFrame:
    """source, severity, title, patterns of all findings about the sources of ``measures``."""
    native = ("vectorset", "graph", "timeseries", "search", "ft", "rejson", "redisjson", "bf", "redisbloom")
    one = lambda severity, title, patterns: F.struct(F.lit(severity).alias("kind"), title.alias("text"), F.array(*map(F.lit, patterns)).cast("array<int>").alias("patterns"))
    others = F.transform(F.filter("modules", lambda m: ~F.lower(m).isin(*native)), lambda m: one("action", F.concat(F.lit("module "), m, F.lit(" cannot be loaded")), ALL))

    def of_type(name: Column) -> Column:
        known = one("action", F.concat(F.lit("the type "), name, F.lit(" is not known")), ALL)
        for kind, (severity, title, patterns) in type_rules.items():
            known = F.when(name == kind, one(severity, F.lit(title), patterns)).otherwise(known)
        return known

    held = F.transform(F.filter(F.map_keys("types"), lambda t: ~t.isin(*NATIVE)), of_type)
    of_facts = wide.select("source", F.explode(F.concat(compiled(rules, wide), F.coalesce(others, F.array().cast("array<struct<kind:string,text:string,patterns:array<int>>>")), held)).alias("f"))
    of_facts = of_facts.select("source", F.col("f.kind").alias("severity"), F.col("f.text").alias("title"), "f.patterns")
    every = F.array(*map(F.lit, ALL)).cast("array<int>").alias("patterns")
    matched = assess.match_rules(commands.select("source", "command").distinct(), command_rules, containers).select("source", "severity", "title", every)
    named = command_rules.filter("kind = 'exact'").select(F.substring_index("pattern", "|", 1).alias("command")).distinct()
    bare = commands.select("source", F.substring_index("command", "|", 1).alias("command")).filter(~F.col("command").isin(*containers) if containers else F.lit(True)).distinct()
    prefixes = command_rules.filter("kind = 'prefix'").select("pattern")
    lacking = assess.missing_commands(bare, target_commands, named)
    starts = lacking.select("command").distinct().withColumn("pattern", F.explode(F.transform(F.sequence(F.lit(1), F.length("command")), lambda n: F.left("command", n))))
    lacking = lacking.join(starts.join(prefixes, "pattern").select("command").distinct(), "command", "left_anti")
    lacking = lacking.groupBy("source").agg(F.concat(F.lit("the target lacks "), F.array_join(F.array_sort(F.collect_set("command")), ", ")).alias("title"))
    return of_facts.unionByName(matched).unionByName(lacking.select("source", F.lit("action").alias("severity"), "title", every))


def copy_advice(wide: DataFrame, rules: list[Rule] = REASON_RULES) -> DataFrame:
    """source, tool, way, typed, payload, limits, checks: which kind of copy, how it follows writes, and why.

    ``tool``: typed, payload, either, or any where nothing speaks for one. A cache without reasons for typed commands and
    without filters is a reason for payloads.
    """
    found = wide.withColumn("_r", compiled(rules, wide))
    of = lambda kind: F.transform(F.filter("_r", lambda r: r["kind"] == kind), lambda r: r["text"])
    quick = F.col("cache_like") & (F.size("typed") == 0) & ~F.coalesce(F.arrays_overlap(F.map_keys("types"), F.array(*map(F.lit, FILTERS))) & ~F.col("same_engine"), F.lit(False))
    none = F.array().cast("array<string>")
    got = found.withColumns({"typed": of("typed"), "checks": of("check"), "limits": of("limit")}).withColumn("payload", F.when(quick, F.array(F.lit("a cache of plain keys: payloads are quicker"))).otherwise(none))
    slow = ~quick & (F.col("keys") >= 1_000_000)
    got = got.withColumn("limits", F.concat("limits", F.when(slow, F.array(F.lit("many small keys: payloads are quicker"))).otherwise(none)))
    t, p = F.size("typed"), F.size("payload")
    tool = F.when((t > 0) & ((p == 0) | (t > p)), "typed").when((p > 0) & (t == 0), "payload").when((t > 0) & (p > 0), "either").otherwise("any")
    live = F.when(F.col("same_engine"), "passes").when((F.col("mode") == "cluster") & ~F.col("closed"), "log").otherwise("events")
    way = F.when(tool == "typed", F.when(F.col("cache_like"), "once").otherwise(live))
    return got.select("source", tool.alias("tool"), way.alias("way"), "typed", "payload", "limits", "checks")


def advise(wide: DataFrame, found: DataFrame) -> DataFrame:
    """source, stop, action, check, info (numbers of findings), statuses (by pattern), pattern, ready, tool, way, typed, payload, limits, checks."""
    n = found.groupBy("source").agg(*(F.count_if(F.col("severity") == s).alias(s) for s in assess.RANK))
    status = assess.pattern_status(found, sources=wide)
    best = assess.recommend(status.join(wide.select("source", "cache_like"), "source"))
    listed = status.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("pattern", "status")))).alias("statuses"))
    return copy_advice(wide).join(n, "source", "left").join(listed, "source").join(best, "source").fillna(0, list(assess.RANK))
