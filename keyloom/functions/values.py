"""Values of key records: JSON envelope, canonical digests, chunks, field expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = "key binary, type string, ttl_ms long, value string, base64 boolean"


def base64_text(b: Column) -> Column:
    """Base64 without line breaks."""
    return F.regexp_replace(F.base64(b), r"\s", "")


def is_text(b: Column) -> Column:
    return F.is_valid_utf8(b.cast("string"))


def to_envelope(records: DataFrame) -> DataFrame:
    """One JSON object per record (key, type, ttl_ms, value as bytes); nulls are left out.

    Key and value each travel as text if they are valid UTF-8, else as base64 with a mark.
    """
    key, value = F.col("key"), F.col("value")
    return records.select(
        F.to_json(F.struct(
            F.when(is_text(key), key.cast("string")).alias("key"),
            F.when(~is_text(key), base64_text(key)).alias("key_base64"),
            F.col("type"), F.col("ttl_ms"),
            F.when(is_text(value), value.cast("string")).otherwise(base64_text(value)).alias("value"),
            F.when(~is_text(value), F.lit(True)).alias("base64"),
        )).alias("line")
    )


ENVELOPE = "key string, key_base64 string, type string, ttl_ms long, value string, base64 boolean, _bad string"


def from_envelope(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and bad lines (line, reason, and what other columns lines has) of a frame with a string column ``line``; blank lines are skipped."""
    more = [c for c in lines.columns if c != "line"]
    parsed = lines.filter(F.trim("line") != "").withColumn(
        "r", F.from_json("line", ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    )
    key = F.coalesce(F.encode("r.key", "UTF-8"), F.unbase64("r.key_base64"))
    reason = F.when(F.col("r").isNull() | F.col("r._bad").isNotNull(), "not a JSON record").when(key.isNull(), "no key").when(F.col("r.type").isNull(), "no type")
    seen = parsed.withColumns({"reason": reason, "k": key})
    value = F.when(F.col("r.base64"), F.unbase64("r.value")).otherwise(F.encode("r.value", "UTF-8"))
    good = seen.filter("reason is null").select(F.col("k").alias("key"), "r.type", "r.ttl_ms", value.alias("value"))
    return good, seen.filter("reason is not null").select("line", "reason", *more)


def digest(kind: Column, elements: Column) -> Column:
    """sha2 of the canonical value: sets and hashes sorted, ordered types as they are. elements: array of strings or structs."""
    canonical = F.when(F.lower(kind).isin("set", "hash"), F.array_sort(elements)).otherwise(elements)
    return F.sha2(F.concat_ws("\x1f", F.to_json(canonical)), 256)


def split_chunks(records: DataFrame, column: str, sizes: dict[str, int]) -> DataFrame:
    """Records whose array column is longer than its type's chunk size become numbered chunks (chunk, chunks)."""
    size = F.lit(1 << 30)
    for kind, n in sizes.items():
        size = F.when(F.col("type") == kind, n).otherwise(size)
    n = F.greatest(F.lit(1), F.ceil(F.size(column) / size)).cast("int")
    with_n = records.withColumns({"_size": size, "chunks": n})
    out = with_n.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    part = F.slice(F.col(column), F.col("chunk") * F.col("_size") + 1, F.col("_size"))
    return out.withColumn(column, F.when(F.col("chunks") > 1, part).otherwise(F.col(column))).drop("_size")


def join_chunks(chunks: DataFrame, column: str, waits: int = 0, max_waits: int = 10, order: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, waiting and failed keys of chunk rows (key, type, chunk, chunks, array column).

    Of a repeated chunk number the first value by ``order`` counts (the smallest one without an order). Only hashes and lists are chunked. Keys with missing
    chunks wait until ``waits`` reaches ``max_waits``.
    """
    one = chunks.groupBy("key", "type", "chunk", "chunks").agg((F.min_by(column, F.struct(*order)) if order else F.min(column)).alias(column))
    whole = one.groupBy("key", "type", "chunks").agg(
        F.count("*").cast("int").alias("n"), F.array_sort(F.collect_list(F.struct("chunk", F.col(column).alias("v")))).alias("parts")
    )
    valid = F.col("type").isin("hash", "list") | (F.col("chunks") == 1)
    done = whole.filter(valid & (F.col("n") == F.col("chunks"))).select("key", "type", F.flatten(F.col("parts.v")).alias(column))
    part = whole.filter(valid & (F.col("n") < F.col("chunks")))
    text = F.format_string("only %d of the key's %d chunks arrived", "n", "chunks")
    failed = whole.filter(~valid).select("key", F.concat(F.lit("chunks of a "), F.col("type")).alias("reason"))
    late = part.select("key", text.alias("reason"))
    if waits < max_waits:
        return done, late, failed
    return done, late.limit(0), failed.unionByName(late)


def project_field_ttls(fields: Column, now_ms: Column, strategy: str = "PRESERVE") -> Column:
    """Hash fields (field, value, expire_at_ms) as (field, value, seconds): whole seconds left, rounded up; past ones go."""
    live = F.filter(fields, lambda f: f["expire_at_ms"].isNull() | (f["expire_at_ms"] > now_ms) | F.lit(strategy == "STRIP"))
    left = lambda f: F.lit(None).cast("long") if strategy == "STRIP" else F.ceil((f["expire_at_ms"] - now_ms) / 1000)
    return F.transform(live, lambda f: F.struct(f["field"].alias("field"), f["value"].alias("value"), left(f).alias("seconds")))


def render_commands(records: DataFrame, chunk: int = 1000) -> DataFrame:
    """(key, seq, argv): ordered commands that rebuild each record (key, type, ttl_ms, items array<string>).

    Multi-element types are deleted first and written in chunks; a string is one SET, with PX if it
    expires; the others get PEXPIRE at the end. Hash and zset items alternate field and value, score and member.
    """
    verb = F.create_map(*(F.lit(x) for p in {"hash": "HSET", "list": "RPUSH", "set": "SADD", "zset": "ZADD"}.items() for x in p))
    width = F.when(F.col("type").isin("hash", "zset"), 2 * chunk).otherwise(chunk)
    n = F.ceil(F.size("items") / width).cast("int")
    parts = F.transform(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(F.array(F.element_at(verb, F.col("type")), F.col("key")), F.slice("items", i * width + 1, width)),
    )
    px = F.col("ttl_ms").cast("string")
    string = F.concat(F.array(F.lit("SET"), F.col("key")), F.slice("items", 1, 1), F.when(F.col("ttl_ms") > 0, F.array(F.lit("PX"), px)).otherwise(F.array().cast("array<string>")))
    expire = F.when(F.col("ttl_ms") > 0, F.array(F.array(F.lit("PEXPIRE"), F.col("key"), px))).otherwise(F.array().cast("array<array<string>>"))
    many = F.concat(F.array(F.array(F.lit("DEL"), F.col("key"))), parts, expire)
    commands = F.when(F.col("type") == "string", F.array(string)).when(F.col("type") == "deleted", F.array(F.array(F.lit("DEL"), F.col("key")))).otherwise(many)
    return records.select("key", F.posexplode(commands).alias("seq", "argv"))
