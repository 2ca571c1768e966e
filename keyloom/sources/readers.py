"""Sources: snapshots, JSON lines, incremental queries, delimited files, records, samples, event and command logs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.functions import keys as K
from keyloom.functions.structured import from_typed_envelope
from keyloom.functions.values import from_envelope
from keyloom.session import checkpointed
from keyloom.sources import lines


def scan_keys(
    df: DataFrame, pattern: str = "*", types: list[str] = (), deny: list[str] = (), only: list[str] = (),
    skip_volatile: bool = False, volatile_ms: int = 1000,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries, failures and keys skipped per type of a listing (key, type, ttl_ms, and perhaps error).

    Pattern and prefixes are applied before the type is looked at, so only keys in scope are counted as skipped.
    """
    scope = df.filter(K.glob_match(F.col("key"), pattern) & K.allows_key(F.col("key"), deny, only))
    failed = F.col("error").isNotNull() if "error" in df.columns else F.lit(False)
    allowed = K.allows_type(F.col("type"), list(types))
    entries = scope.filter(~failed & allowed)
    if skip_volatile:
        entries = entries.filter(K.not_volatile(F.col("ttl_ms"), volatile_ms))
    skipped = scope.filter(~failed & ~allowed).groupBy("type").agg(F.count("*").alias("n"))
    return entries, scope.filter(failed), skipped


def fetch_values(entries: DataFrame, values: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Records, missing keys, keys of module types and failures: entries joined with values (key, value, and perhaps error) by key."""
    core = F.lower("type").isin(*K.CORE_TYPES)
    v = values if "error" in values.columns else values.withColumn("error", F.lit(None).cast("string"))
    met = entries.filter(core).join(v.withColumn("_there", F.lit(True)), "key", "left")
    records = met.filter("_there and error is null").drop("_there", "error")
    return records, met.filter("_there is null").select("key", "type"), entries.filter(~core), met.filter("error is not null").select("key", F.col("error").alias("reason"))


def read_key_records(spark: SparkSession, path: str, stream: bool = False, typed: bool = False, positions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Records and bad lines (line, reason, position) of JSON-lines files; with ``typed`` in the columns of ``structured.VALUES``.

    ``position`` is ``file@byte`` of the line. ``positions`` (file, next, see ``lines.read_up_to``) leaves out what was read
    before. A stream has no positions, as its micro-batches get theirs from ``key_records`` in a foreachBatch.
    """
    if stream:
        return (from_typed_envelope if typed else from_envelope)(lines.raw_lines(spark, path, True).select("line"))
    return key_records(lines.after(lines.with_positions(lines.raw_lines(spark, path)), positions), typed)


def key_records(placed: DataFrame, typed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records and bad lines (line, reason, position) of lines with positions."""
    named = placed.select("line", F.concat("file", F.lit("@"), F.col("byte").cast("string")).alias("position"))
    return (from_typed_envelope if typed else from_envelope)(named)


def read_incremental(spark: SparkSession, sql: str, cursor_col: str | None, cursor: str = "") -> tuple[DataFrame, DataFrame]:
    """Rows of a query with a ``${cursor}`` token, and the next cursor as one row.

    The token is a parameter of the query, a string, whether it stands in quotes or not. The next cursor is that of the last row
    in the query's own order, so a query should order by it. No rows keep the cursor; without a cursor column the
    whole query runs each time. The caller stores the cursor after its sink has committed, so a failed run repeats
    its rows.
    """
    asked = spark.sql(re.sub(r"'?\$\{cursor\}'?", ":cursor", sql), args={"cursor": cursor})
    rows = checkpointed(asked.withColumn("_row", F.monotonically_increasing_id()))  # rows and cursor are of one reading
    if cursor_col is None:
        return rows.drop("_row"), spark.range(1).select(F.lit(cursor).alias("cursor"))
    return rows.drop("_row"), rows.agg(F.coalesce(F.max_by(F.col(cursor_col), "_row").cast("string"), F.lit(cursor)).alias("cursor"))


def ingest_delimited(spark: SparkSession, path: str, file_type: str = "csv", delimiter: str | None = None, file_filter: str | None = None) -> DataFrame:
    """Rows of delimited files with a header; ``file_filter`` is a regular expression on the file's name."""
    sep = delimiter or {"tsv": "\t", "csv": ","}[file_type]
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    if file_filter:
        df = df.filter(F.col("_metadata.file_name").rlike(f"^(?:{file_filter})$"))
    return df


def template(text: str, tokens: dict[str, Column]) -> Column:
    """``text`` with its ``${name}`` tokens replaced by columns; null if one of them is null."""
    parts: list[Column] = []
    while text:
        before, found, rest = text.partition("${")
        if before:
            parts.append(F.lit(before))
        if not found:
            break
        name, _, text = rest.partition("}")
        parts.append((tokens[name] if name in tokens else F.col(name)).cast("string"))
    return F.concat(*parts)


def to_key_records(df: DataFrame, key_format: str, target_type: str = "hash", ttl_ms: int = -1, file: Column | None = None, tokens: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Key records of any rows, and rows that failed with a reason.

    hash: one field per column, nested ones as JSON, nulls as the text null; json: the row as a document.
    A row whose key has a null part fails, and with it all rows of its ``file``.
    """
    key = template(key_format, tokens or {})
    if target_type == "hash":
        text = lambda f: F.to_json(f.name) if f.dataType.typeName() in ("struct", "array", "map") else F.col(f.name).cast("string")
        value = F.array(*(F.struct(F.lit(f.name).alias("field"), F.coalesce(text(f), F.lit("null")).alias("value")) for f in df.schema.fields))
    else:
        value = F.to_json(F.struct(*df.columns))
    bad = F.col("key").isNull()
    rows = df.select(key.alias("key"), F.lit(target_type).alias("type"), F.lit(ttl_ms).cast("long").alias("ttl_ms"), value.alias("value"), *([file.alias("_file")] if file is not None else []))
    if file is not None:
        spoilt = rows.filter(bad).select("_file").distinct().withColumn("_bad", F.lit(True))
        rows = rows.join(spoilt, "_file", "left")
        bad = F.col("_bad").isNotNull()
    good = rows.filter(~bad).select("key", "type", "ttl_ms", "value")
    return good, rows.filter(bad).select("key", F.lit("a record of the input has no key").alias("reason"))


def ingest_records(
    spark: SparkSession, path: str, primary_key: str, target_type: str = "hash", key_prefix: str = "", file_type: str = "csv",
    delimiter: str | None = None, file_filter: str | None = None, ttl_ms: int = -1,
) -> tuple[DataFrame, DataFrame]:
    """Key records of delimited files, and rows that failed: the key is ``key_prefix:`` and the field ``primary_key``, or that field alone.

    A row without its primary key fails with all rows of its file. Fields are text, as files have no types.
    """
    if target_type not in ("hash", "json"):
        raise ValueError(f"records of files become hash or json, not {target_type}")
    rows = ingest_delimited(spark, path, file_type, delimiter, file_filter)
    if primary_key not in rows.columns:
        raise ValueError(f"the files have no field {primary_key}: {', '.join(rows.columns)}")
    key = ("${prefix}:" if key_prefix else "") + "${id}"
    return to_key_records(rows, key, target_type, ttl_ms, F.col("_metadata.file_path"), {"prefix": F.lit(key_prefix), "id": F.col(f"`{primary_key}`")})


def sample_keys(df: DataFrame, n: int, seed: str = "") -> DataFrame:
    """n keys by a seeded hash: random, and the same each time."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col("key"))), "key").limit(n)


def head_keys(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy("key").limit(n)


EVENTS = "channel string, message string, ts timestamp"
COMMANDS = "shard string, generation long, offset_after long, argv array<string>"


def read_events(spark: SparkSession, path: str, stream: bool = True, max_files: int = 100, file_format: str = "parquet") -> DataFrame:
    """Keyspace notifications (channel, message, ts) from files; as a stream, so many files a trigger.

    Of a file's columns these three are read, absent ones are null. A line of JSON or CSV files that cannot be read has
    a null channel, which ``sync.route_events`` routes to failure.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if stream else spark.read
    return reader.format(file_format).schema(EVENTS).load(path)


def events_of_messages(messages: DataFrame) -> DataFrame:
    """Notifications of a message log's rows (key, value, timestamp), as Spark's Kafka source has them: the channel is the key."""
    text = lambda name: F.col(name).cast("string")
    return messages.select(text("key").alias("channel"), text("value").alias("message"), F.col("timestamp").alias("ts"))


def read_command_log(spark: SparkSession, path: str, positions: DataFrame | None = None, stream: bool = False) -> DataFrame:
    """A replication log; in batch, only what lies behind each shard's saved position (shard, offset)."""
    if stream:
        return spark.readStream.schema(COMMANDS).parquet(path)
    log = spark.read.schema(COMMANDS).parquet(path)
    if positions is None:
        return log
    seen = positions.select("shard", F.col("offset").alias("_seen"))
    return log.join(seen, "shard", "left").filter(F.col("_seen").isNull() | (F.col("offset_after") > F.col("_seen"))).drop("_seen")


def bootstrap_then_follow(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot keys (shard, generation, offset, key) and then changed keys behind the snapshot's offset.

    Only the newest generation of a shard counts, of its listing and, if changes have a generation, of its changes, whose
    offsets begin anew with each; snapshot rows have the lowest sequence. ``streaming.follow`` is the form for streams.
    """
    newest = snapshot.groupBy("shard").agg(F.max_by(F.struct("generation", "offset"), "generation").alias("at"))
    newest = newest.select("shard", F.col("at.generation").alias("_g"), F.col("at.offset").alias("_o"))
    listed = snapshot.join(newest, "shard").filter("generation = _g").select("shard", "key", F.lit(-1).cast("long").alias("seq"))
    behind = (F.col("offset") > F.col("_o")) & (F.coalesce("generation", "_g") == F.col("_g") if "generation" in changes.columns else F.lit(True))
    follow = changes.join(newest, "shard", "left").filter(F.col("_o").isNull() | behind).select("shard", "key", F.col("offset").alias("seq"))
    return listed.unionByName(follow)
