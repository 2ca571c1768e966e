"""Applying records to a target, live changes, repairs, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.operators.ranks import numbered

EXISTS = "the key already exists on the target and conflict-strategy is FAIL"
COLLIDES = "no target name: a renamed key could land on it"


def latest_per_key(records: DataFrame, order: list[str], key: str = "key") -> tuple[DataFrame, DataFrame]:
    """The newest record of every key, and those it supersedes. ``order``: columns of the sequence, ascending."""
    newest = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
    ranked = records.withColumn("_rn", F.row_number().over(newest))
    return ranked.filter("_rn = 1").drop("_rn"), ranked.filter("_rn > 1").drop("_rn")


def mapped(records: DataFrame, names: K.KeyNames) -> tuple[DataFrame, DataFrame]:
    """Records under their target names, and those without one as failures (key, reason)."""
    named = records.withColumn("_target", names.to_target(F.col("key")))
    good = named.filter("_target is not null").withColumn("key", F.col("_target")).drop("_target")
    return good, named.filter("_target is null").select("key", F.lit(COLLIDES).alias("reason"))


def newest(records: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """One record a key, with these columns: the newest by ``order``; without one, the largest by its columns, which tells repeated rows apart."""
    if order:
        return latest_per_key(records, order)[0].select(*columns)
    rest = [c for c in columns if c != "key"]
    return records.groupBy("key").agg(F.max(F.struct(*rest)).alias("_r")).select("key", "_r.*").select(*columns)


def decided(records: DataFrame, target: DataFrame, conflict: str) -> tuple[DataFrame, DataFrame]:
    """Which records (one a key) are written, and the outcome (key, outcome, reason) of each. OVERWRITE need not look at the target."""
    if conflict == "OVERWRITE":
        return records, records.select("key", F.lit("success").alias("outcome"), F.lit(None).cast("string").alias("reason"))
    there = target.select("key").distinct().withColumn("_there", F.lit(True))
    met = records.join(there, "key", "left")
    taken = F.col("_there").isNotNull() & (F.col("type") != "deleted")
    met = met.withColumn("outcome", F.when(taken, "skipped" if conflict == "SKIP" else "failure").otherwise("success"))
    reason = F.when(F.col("outcome") == "failure", EXISTS)
    return met.filter("outcome = 'success'").drop("_there", "outcome"), met.select("key", "outcome", reason.alias("reason"))


def upsert(records: DataFrame, target: DataFrame, conflict: str = "OVERWRITE", order: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The new target and an outcome (key, outcome, reason) per key; ``deleted`` records remove it.

    Of several records of a key the newest by ``order`` is applied; without an order they should be equal, and the largest by
    its columns is. OVERWRITE replaces whole values, SKIP leaves what is there, FAIL reports it. Both sides have the
    same columns. This computes a whole target; ``buckets.BucketedTarget`` changes the buckets of the records alone.
    """
    if not order and any(f.dataType.typeName() in ("map", "variant") for f in target.schema.fields):
        raise ValueError("records that cannot be compared need an order")
    last = newest(records, list(order), target.columns)
    done, outcomes = decided(last, target, conflict)
    # where the target has the key, only OVERWRITE and deletions are applied; an anti join would be made anew for each part of a target that is a union
    applied = records if conflict == "OVERWRITE" else last.filter("coalesce(type = 'deleted', true)")
    met = target.join(applied.select("key").distinct().withColumn("_applied", F.lit(True)), "key", "left")
    kept = met.filter("_applied is null").select(*target.columns)
    return kept.unionByName(done.filter("type <> 'deleted'").select(*target.columns)), outcomes


def apply_deletes(events: DataFrame, target: DataFrame, names: K.KeyNames = K.KeyNames()) -> tuple[DataFrame, DataFrame]:
    """The target without the deleted keys, and an outcome per event: a missing key name fails, all else succeeds."""
    named = events.withColumn("_target", names.to_target(F.col("key")))
    gone = named.filter("_target is not null").select(F.col("_target").alias("key")).distinct()
    outcome = F.when(F.col("key").isNull(), "failure").otherwise("success")
    return target.join(gone, "key", "left_anti"), named.select("key", outcome.alias("outcome"))


def current_values(changed: DataFrame, source: DataFrame, types: list[str] = ()) -> DataFrame:
    """What a changed key is now: its record, or a tombstone if it is gone or of a type left out."""
    met = changed.select("key").distinct().join(source.withColumn("_there", F.lit(True)), "key", "left")
    here = F.col("_there").isNotNull() & K.allows_type(F.col("type"), list(types))
    cols = [c for c in source.columns if c != "key"]
    return met.select("key", *((F.when(here, F.col(c)).otherwise(F.lit("deleted") if c == "type" else F.lit(None))).alias(c) for c in cols))


def apply_repairs(diffs: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """The target after every different key has been copied again, or deleted where the source has none."""
    return upsert(current_values(diffs, source), target)[0]


def reconcile_until_clean(source: DataFrame, target: DataFrame, rounds: int = 3, settle=lambda df: df) -> tuple[DataFrame, int, int]:
    """Full passes with repairs until one finds nothing: the target, passes made, differences of the last."""
    from keyloom.operators.reconcile import first_differences

    left = -1
    for done in range(1, rounds + 1):
        diffs = settle(first_differences(source, target))
        left = diffs.count()
        if not left:
            return target, done, 0
        target = settle(apply_repairs(diffs, source, target))
    return target, rounds, left


def existence_routes(target_keys: DataFrame, source: DataFrame, names: K.KeyNames = K.KeyNames(), deny: list[str] = (), only: list[str] = ()) -> DataFrame:
    """(key, source_key, route, reason): exists, missing, filtered or failure for every target key.

    Scope is decided before the lookup, so a key out of scope is filtered whatever the source says of it. A null or
    empty key fails, as does one that ``source`` (key, and perhaps error) could not be asked about; of several
    answers for a key one that says it is there counts, then the smallest error. Repeated target keys stay.
    """
    named = target_keys.select("key").withColumn("source_key", names.to_source(F.col("key")))
    named = named.withColumn("_scope", F.col("source_key").isNotNull() & K.allows_key(F.col("source_key"), deny, only))
    error = F.col("error") if "error" in source.columns else F.lit(None).cast("string")
    answers = source.groupBy(F.col("key").alias("source_key")).agg(F.bool_or(error.isNull()).alias("_there"), F.min(error).alias("_error"))
    met = named.join(answers, "source_key", "left")
    none = F.length("key") == 0
    reason = F.when(F.col("key").isNull() | none, "no key").when(F.col("_scope") & ~F.col("_there"), F.concat(F.lit("the source could not be asked: "), "_error"))
    route = F.when(reason.isNotNull(), "failure").when(~F.col("_scope"), "filtered").when(F.col("_there"), "exists").otherwise("missing")
    return met.select("key", "source_key", route.alias("route"), reason.alias("reason"))


def existence(target_keys: DataFrame, source: DataFrame, names: K.KeyNames = K.KeyNames(), deny: list[str] = (), only: list[str] = ()) -> DataFrame:
    """(key, source_key, route) of ``existence_routes``."""
    return existence_routes(target_keys, source, names, deny, only).select("key", "source_key", "route")


def assign_batches(records: DataFrame, order: list[str], default: int = 50, per_type: dict[str, int] | None = None) -> DataFrame:
    """records with ``bucket`` (a type with its own cap, or shared) and ``batch``, numbered from 1 in each bucket."""
    per_type = per_type or {}
    bucket, cap = F.lit("shared"), F.lit(default)
    for kind, n in per_type.items():
        bucket, cap = F.when(F.col("type") == kind, kind).otherwise(bucket), F.when(F.col("type") == kind, n).otherwise(cap)
    n = numbered(records.withColumns({"bucket": bucket, "_cap": cap}), ["bucket"], order, "_n")
    return n.withColumn("batch", F.ceil(F.col("_n") / F.col("_cap")).cast("long")).drop("_cap", "_n")


def dead_letters(failures: DataFrame, keep: int = 20, existing: DataFrame | None = None) -> DataFrame:
    """One record per key and chunk of failures (key, chunk, reason, failed_at, seq): the newest, and older reasons newest first.

    ``existing`` records (of an earlier result) count as older failures with their history; seq must not be negative.
    """
    if existing is not None:
        past = F.concat(F.array(F.struct("failed_at", "reason")), "history")
        past = existing.select("key", "chunk", F.posexplode(past).alias("pos", "h"))
        failures = failures.unionByName(past.select("key", "chunk", "h.reason", "h.failed_at", (-1 - F.col("pos")).alias("seq")))
    newest = Window.partitionBy("key", "chunk").orderBy(F.desc("failed_at"), F.desc("seq"))
    f = failures.withColumn("reason", F.coalesce("reason", F.lit("no reason recorded"))).withColumn("_rn", F.row_number().over(newest))
    f = f.filter(F.col("_rn") <= keep + 1)
    older = F.array_sort(F.collect_list(F.when(F.col("_rn") > 1, F.struct("_rn", "failed_at", "reason"))))
    return f.groupBy("key", "chunk").agg(
        F.max(F.when(F.col("_rn") == 1, F.col("reason"))).alias("reason"), F.max("failed_at").alias("failed_at"),
        F.transform(older, lambda h: F.struct(h["failed_at"].alias("failed_at"), h["reason"].alias("reason"))).alias("history"),
    ).withColumn("id", F.sha2(F.col("key").cast("binary"), 256))


def pending(letters: DataFrame) -> DataFrame:
    return letters.agg(F.count("*").alias("pending"))


def route(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reason to fail."""
    return df.filter(F.col(reason).isNull()).drop(reason), df.filter(F.col(reason).isNotNull())


def remap_db(df: DataFrame, source_db: int, target_db: int) -> DataFrame:
    return df.filter(F.col("db") == source_db).withColumn("db", F.lit(target_db))


def with_hook(records: DataFrame, hook) -> DataFrame:
    """User code sees the records as a DataFrame and may drop, edit or fail them (a non-null ``reason``)."""
    out = hook(records)
    return out if "reason" in out.columns else out.withColumn("reason", F.lit(None).cast("string"))


def validate(source: DataFrame, target: DataFrame, mode: str = "FULL_VALUE", tolerance_ms: int = 5000) -> DataFrame:
    """(key, result) of sampled source keys against the target: ok, missing, type, value or ttl.

    EXISTENCE, TYPE, FULL_VALUE or TTL_DELTA; each mode runs the tests before it. Raw TTLs are compared in
    milliseconds. Values may be arrays of elements: those of sets and zsets (member and score) are compared as sets.
    """
    if dict(source.dtypes)["value"].startswith("array"):
        alike = F.when(F.col("type").isin("set", "zset"), F.array_sort(F.array_distinct("value"))).otherwise(F.col("value"))
        source, target = source.withColumn("value", alike), target.withColumn("value", alike)
    t = target.select("key", *(F.col(c).alias(f"t_{c}") for c in ("type", "ttl_ms", "value")), F.lit(True).alias("_there"))
    result = F.when(F.col("_there").isNull(), "missing")
    if mode != "EXISTENCE":
        result = result.when(F.col("type") != F.col("t_type"), "type")
    if mode == "FULL_VALUE":
        result = result.when(~F.col("value").eqNullSafe(F.col("t_value")), "value")
    if mode == "TTL_DELTA":
        result = result.when(F.abs(F.col("ttl_ms") - F.col("t_ttl_ms")) > tolerance_ms, "ttl")
    return source.join(t, "key", "left").select("key", result.otherwise("ok").alias("result"))


def validation_summary(checks: DataFrame) -> DataFrame:
    n = lambda *k: F.count_if(F.col("result").isin(*k))
    return checks.agg(
        F.count("*").alias("checked"), n("ok").alias("passed"), n("missing", "type", "value", "ttl").alias("failed"),
        n("missing").alias("missing"), n("type").alias("type_mismatch"), n("value", "ttl").alias("value_mismatch"),
    )


# ---- change streams, in the form that batch and micro-batch share


def route_events(events: DataFrame, types: list[str] = (), deny: list[str] = (), only: list[str] = ()) -> DataFrame:
    """events (channel, message) with db, event, key and route: changed, deleted, expired, filtered or failure.

    Both channel families are read: __keyevent@n__:event with the key as message, __keyspace@n__:key with the event.
    """
    part = lambda g: F.regexp_extract("channel", r"(?s)^__(keyevent|keyspace)@(\d+)__:(.*)$", g)
    family = part(1)
    event = F.when(family == "keyevent", part(3)).when(family == "keyspace", F.col("message"))
    key = F.when(family == "keyevent", F.col("message")).when(family == "keyspace", part(3))
    out = events.withColumns({"event": event, "key": key, "db": F.when(family != "", part(2)).cast("int")})
    wanted = F.lower("event").isin(*(t.lower() for t in types)) if types else F.lit(True)
    route = (
        F.when(F.col("key").isNull() | (F.col("key") == "") | F.col("event").isNull(), "failure")
        .when(~K.allows_key(F.col("key"), deny, only) | ~wanted, "filtered")
        .when(F.col("event").isin("del", "rename_from", "move_from"), "deleted")
        .when(F.col("event") == "expired", "expired").otherwise("changed")
    )
    return out.withColumn("route", route)


def with_database(log: DataFrame, span: int = 1_000_000) -> DataFrame:
    """The database each command of a log (shard, generation, offset_after, argv) ran on: the last SELECT, 0 at first.

    A shard's log is cut into spans of offsets. The last choice of every span is carried to the next ones, a row
    a span; only within a span rows are looked at in order.
    """
    chosen = F.when(F.lower(F.get("argv", F.lit(0))) == "select", F.get("argv", F.lit(1)).cast("int"))
    cut = log.withColumns({"_span": F.floor(F.col("offset_after") / span), "_db": chosen})
    last = cut.filter("_db is not null").groupBy("shard", "generation", "_span").agg(F.max_by("_db", "offset_after").alias("_last"))
    spans = cut.select("shard", "generation", "_span").distinct().join(last, ["shard", "generation", "_span"], "left")
    before = Window.partitionBy("shard", "generation").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("_from", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    so_far = Window.partitionBy("shard", "generation", "_span").orderBy("offset_after").rowsBetween(Window.unboundedPreceding, 0)
    met = cut.join(carried, ["shard", "generation", "_span"])
    met = met.withColumn("db", F.coalesce(F.last("_db", ignorenulls=True).over(so_far), F.col("_from"), F.lit(0)))
    return met.select(*log.columns, "db")


def command_keys(log: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys that commands touch, and commands that a server has to resolve.

    commands: name (``cmd`` or ``cmd|sub``), first, last, step, movable. A container's subcommand goes before its
    base; a negative last counts from the end; first 0 touches no key. Both lookups are joins on the name.
    """
    base, sub = F.lower(F.get("argv", F.lit(0))), F.lower(F.get("argv", F.lit(1)))
    table = lambda p: commands.select(F.col("name").alias(f"{p}n"), F.struct("first", "last", "step", "movable").alias(p))
    t = log.withColumns({"_base": base, "_sub": F.concat_ws("|", base, sub)})
    t = t.join(table("_b"), F.col("_base") == F.col("_bn"), "left").join(table("_s"), F.col("_sub") == F.col("_sn"), "left")
    t = t.withColumn("_r", F.coalesce("_s", "_b")).drop("_base", "_sub", "_b", "_bn", "_s", "_sn")
    open_ = F.col("_r").isNull() | F.col("_r.movable")
    size = F.size("argv")
    last = F.least(size - 1, F.when(F.col("_r.last") < 0, size + F.col("_r.last")).otherwise(F.col("_r.last")))
    at = F.when((F.col("_r.first") > 0) & (last >= F.col("_r.first")), F.sequence(F.col("_r.first"), last, F.greatest(F.lit(1), F.col("_r.step"))))
    keys = t.filter(~open_).withColumn("key", F.explode(F.transform(at, lambda i: F.get("argv", i)))).drop("_r")
    return keys, t.filter(open_).drop("_r")


def changed_keys(log: DataFrame, commands: DataFrame, database: int = 0, getkeys: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct keys of one database that a log changes, with the last offset; and what could not be resolved.

    getkeys (argv, keys): a server's answers for commands whose keys the table cannot tell. A command line without
    an answer stays unresolved; one with an empty answer touches no key.
    """
    keys, unresolved = command_keys(with_database(log).filter(F.col("db") == database), commands)
    if getkeys is not None:
        answers = getkeys.select("argv", "keys").dropDuplicates(["argv"])
        told = unresolved.join(answers, "argv").withColumn("key", F.explode("keys"))
        keys, unresolved = keys.unionByName(told.select(*keys.columns)), unresolved.join(answers, "argv", "left_anti").select(*unresolved.columns)
    return keys.groupBy("key").agg(F.max("offset_after").alias("offset")), unresolved


def flushes(log: DataFrame, database: int = 0) -> DataFrame:
    """Commands that empty the database or swap it away: each asks for a full pass."""
    name = F.lower(F.get("argv", F.lit(0)))
    touched = F.array_contains(F.slice("argv", 2, 2), str(database))
    return with_database(log).filter((name == "flushall") | (name == "flushdb") & (F.col("db") == database) | (name == "swapdb") & touched)


def arrivals(log: DataFrame, database: int = 0) -> DataFrame:
    """Keys that come from other databases: MOVE key db, COPY source destination ... DB n."""
    name, arg = F.lower(F.get("argv", F.lit(0))), lambda i: F.get("argv", F.lit(i))
    at = F.array_position(F.transform("argv", lambda a: F.lower(a)), "db").cast("int")
    copied = (name == "copy") & (at > 0) & (F.get("argv", at) == str(database))
    moved = (name == "move") & (arg(2) == str(database))
    key = F.when(moved, arg(1)).when(copied, arg(2))
    return with_database(log).filter(F.col("db") != database).withColumn("key", key).filter("key is not null")
