"""Fleet assessment: facts about sources against rule tables give findings, a status per pattern and advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = {"info": 0, "check": 1, "action": 2, "stop": 3}
STATUS = {0: "READY", 1: "READY AFTER CHECKS", 2: "READY AFTER WORK", 3: "BLOCKED"}


def severity_rank(severity: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for p in RANK.items() for x in p)), severity)


def version_tuple(text: Column) -> Column:
    """(major, minor, patch) of the first three numbers of a version text; missing ones are 0."""
    n = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("int"))
    return F.struct(*(F.coalesce(F.get(n, F.lit(i)), F.lit(0)).alias(k) for i, k in enumerate(("major", "minor", "patch"))))


def command_calls(stats: DataFrame) -> DataFrame:
    """(source, command, calls) from stat lines (source, command, stat) such as calls=12,usec=3."""
    return stats.groupBy("source", "command").agg(F.sum(F.regexp_extract("stat", r"calls=(\d+)", 1).try_cast("long")).alias("calls"))


def missing_commands(source: DataFrame, target: DataFrame, rules: DataFrame) -> DataFrame:
    """Commands of sources (source, command) that the target lacks and no rule (command) names yet."""
    gone = source.join(target.select("command"), "command", "left_anti")
    return gone.join(rules.select("command"), "command", "left_anti")


def match_rules(commands: DataFrame, rules: DataFrame, containers: list[str] = ()) -> DataFrame:
    """(source, title, severity, command) of commands (source, command: ``cmd`` or ``cmd|sub``) that rules (kind exact or prefix, position, pattern, title, severity) fit.

    The exact name goes first, then the base command (never for containers), then of the prefixes that the
    base starts with the first by ``position``; the first command by name stands for a title.
    """
    base = F.substring_index("command", "|", 1)
    c = commands.withColumn("_base", F.when(F.col("command").contains("|") & ~base.isin(*containers), base)) if containers else commands.withColumn("_base", base)
    exact = rules.filter("kind = 'exact'").select("pattern", F.struct("title", "severity").alias("rule"))
    e = exact.select(F.col("pattern").alias("_ep"), F.col("rule").alias("_e"))
    b = exact.select(F.col("pattern").alias("_bp"), F.col("rule").alias("_b"))
    starts = c.select("command").distinct().filter(F.length(base) > 0).withColumn("_x", F.explode(F.transform(F.sequence(F.lit(1), F.length(base)), lambda n: F.left(base, n))))
    fits = starts.join(rules.filter("kind = 'prefix'").select(F.col("pattern").alias("_x"), F.struct("title", "severity").alias("_f"), "position"), "_x")
    first = fits.groupBy("command").agg(F.min_by("_f", "position").alias("_f"))
    met = c.join(e, F.col("command") == F.col("_ep"), "left").join(b, F.col("_base") == F.col("_bp"), "left").join(first, "command", "left")
    hit = met.withColumn("_r", F.coalesce("_e", "_b", "_f")).filter("_r is not null").select("source", "command", "_r.title", "_r.severity")
    return hit.groupBy("source", "title", "severity").agg(F.min("command").alias("command"))


def format_for(sources: DataFrame, ranges: DataFrame) -> DataFrame:
    """sources (source, family, version) with the file format of the range (family, from_version, format) they fall into."""
    r = ranges.select("family", version_tuple(F.col("from_version")).alias("_from"), "format")
    met = sources.withColumn("_v", version_tuple(F.col("version"))).join(r, "family", "left").filter("_from is null or _from <= _v")
    best = met.groupBy("source").agg(F.max_by("format", "_from").alias("format"))
    return sources.join(best, "source", "left")


def capability_gaps(source: DataFrame, target: DataFrame, same_engine_only: list[str] = ("bloom", "cms")) -> DataFrame:
    """(source, capability, reason) of sources (source, capability, same_engine, indexes) that cannot land.

    Some capabilities move only between sides of the same engine; search counts only if there are indexes.
    """
    cap = F.col("capability")
    opaque = cap.isin(*same_engine_only)
    by_engine = source.filter(opaque & ~F.col("same_engine")).select("source", "capability", F.lit("moves only between sides of the same engine").alias("reason"))
    rest = source.filter(~opaque & ((cap != "search") | (F.col("indexes") > 0))).join(target.select("capability"), "capability", "left_anti")
    return by_engine.unionByName(rest.select("source", "capability", F.lit("the target lacks it").alias("reason")))


def fact_findings(facts: DataFrame, target_max: Column | None = None) -> DataFrame:
    """Findings from facts (source, used, target_max, target_keys, managed, notify, mode, aof): capacity, mixed data, hosting, flags."""
    rules = [
        ("stop", "the data does not fit the target", F.col("used") > (target_max if target_max is not None else F.col("target_max"))),
        ("check", "the target already holds keys", F.col("target_keys") > 0),
        ("check", "managed source: some commands may be closed", F.col("managed")),
        ("action", "keyspace notifications are off", F.coalesce(F.col("notify"), F.lit("")) == ""),
        ("check", "cluster source: copy every master", F.col("mode") == "cluster"),
        ("info", "append-only file is on", F.col("aof")),
    ]
    found = F.filter(F.array(*(F.when(test, F.struct(F.lit(s).alias("severity"), F.lit(t).alias("title"))) for s, t, test in rules)), lambda x: x.isNotNull())
    return facts.select("source", F.explode(found).alias("f")).select("source", "f.severity", "f.title")


def type_findings(types: DataFrame, rules: DataFrame) -> DataFrame:
    """Findings for types that sources hold (source, type, n) by rules (type, severity, title)."""
    return types.withColumn("type", F.lower("type")).join(rules, "type").select("source", "severity", "title")


def acl_findings(acls: DataFrame) -> DataFrame:
    """Users (source, user, rule) with key patterns or channels: their rules must be made again on the target."""
    limited = F.col("rule").rlike(r"(^|\s)(~(?!\*(\s|$))|%[RW]+~|&(?!\*(\s|$)))")
    return acls.filter(limited).groupBy("source").agg(F.count("*").alias("n")).select("source", F.lit("check").alias("severity"), F.format_string("%d users with key or channel patterns", "n").alias("title"))


def assess(facts: DataFrame, commands: DataFrame, types: DataFrame, acls: DataFrame, command_rules: DataFrame, type_rules: DataFrame, target_commands: DataFrame, containers: list[str] = ()) -> DataFrame:
    """(source, severity, title) of all findings about many sources in one frame: facts, commands by rule and missing on the target, types, users."""
    lacking = missing_commands(commands, target_commands, command_rules.filter("kind = 'exact'").select(F.col("pattern").alias("command")))
    lacking = lacking.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("command")), ", ").alias("c"))
    found = [
        fact_findings(facts), type_findings(types, type_rules), acl_findings(acls),
        match_rules(commands, command_rules, containers).select("source", "severity", "title"),
        lacking.select("source", F.lit("check").alias("severity"), F.concat(F.lit("the target lacks "), "c").alias("title")),
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def sorted_findings(findings: DataFrame) -> DataFrame:
    return findings.orderBy(F.desc(severity_rank(F.col("severity"))), "source", "title")


def pattern_status(findings: DataFrame, patterns: int = 3, sources: DataFrame | None = None) -> DataFrame:
    """(source, pattern, status) of sources (source; those with findings if not given) from findings (source, severity, patterns array<int>).

    Sources without a finding for a pattern are ready for it.
    """
    every = (findings if sources is None else sources).select("source").distinct().withColumn("pattern", F.explode(F.array(*map(F.lit, range(1, patterns + 1)))))
    worst = findings.select("source", F.explode("patterns").alias("pattern"), severity_rank(F.col("severity")).alias("rank")).groupBy("source", "pattern").agg(F.max("rank").alias("rank"))
    status = F.element_at(F.create_map(*(F.lit(x) for p in STATUS.items() for x in p)), F.coalesce("rank", F.lit(0)))
    return every.join(worst, ["source", "pattern"], "left").select("source", "pattern", status.alias("status"))


def recommend(status: DataFrame) -> DataFrame:
    """(source, pattern, ready) of statuses (source, cache_like, pattern, status): the first ready pattern, else the first not blocked.

    Caches try 1, 2, 3; durable data 2, 3, 1. Null: every pattern is blocked.
    """
    order = F.when(F.col("cache_like"), F.col("pattern")).otherwise(F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), F.col("pattern")))
    first = lambda ok: F.min_by("pattern", F.when(ok, order))
    got = status.groupBy("source").agg(first(F.col("status") == "READY").alias("_r"), first(F.col("status") != "BLOCKED").alias("_o"), F.count_if(F.col("status") == "READY").alias("_n"), F.count_if(F.col("status") != "BLOCKED").alias("_m"))
    return got.select("source", F.when(F.col("_n") > 0, F.col("_r")).when(F.col("_m") > 0, F.col("_o")).alias("pattern"), (F.col("_n") > 0).alias("ready"))


def pending_streams(streams: DataFrame) -> DataFrame:
    """One row (streams, groups) for streams (key, groups array<struct<name, pending: int>>) with pending entries."""
    waiting = F.filter("groups", lambda g: g["pending"] > 0)
    return streams.withColumn("_w", F.size(waiting)).filter("_w > 0").agg(F.count("*").alias("streams"), F.coalesce(F.sum("_w"), F.lit(0)).alias("groups"))


def suggest(reasons: DataFrame) -> DataFrame:
    """(source, tool, score, reasons) of reasons (source, tool, weight, reason): the tool with the best sum, ties by name."""
    each = reasons.groupBy("source", "tool").agg(F.sum("weight").alias("score"), F.array_sort(F.collect_list("reason")).alias("reasons"))
    best = Window.partitionBy("source").orderBy(F.desc("score"), "tool")
    return each.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1").drop("_rn")
