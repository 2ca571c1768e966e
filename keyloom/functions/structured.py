"""Values with structure: their JSON envelope, the commands that rebuild streams and documents, hashes merged from chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions.values import base64_text, is_text, join_chunks, project_field_ttls

PAIRS = "array<struct<field: binary, value: binary>>"
SCORED = "array<struct<member: binary, score: double>>"
ENTRIES = f"array<struct<id: string, fields: {PAIRS}>>"
VALUES = {"text": "binary", "members": "array<binary>", "fields": PAIRS, "scored": SCORED, "entries": ENTRIES}
PENDING = "array<struct<id: string, consumer: binary, delivered_at_ms: long, deliveries: long>>"
GROUPS = f"array<struct<name: binary, last_delivered_id: string, entries_read: long, consumers: array<binary>, pending: {PENDING}>>"
LINE = "key string, key_base64 string, type string, ttl_ms long, value string, base64 boolean, last_id string, groups string, _bad string"


def quoted(text: Column) -> Column:
    """A string as a JSON string."""
    one = F.to_json(F.array(text))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def to_typed_envelope(records: DataFrame) -> DataFrame:
    """One JSON line per record: key binary, type, ttl_ms and one of the columns of ``VALUES``.

    ``text`` holds a string or a JSON document, ``members`` a list or set, ``fields`` a hash, ``scored`` a sorted set,
    ``entries`` a stream. All byte strings of a value travel as text if every one is valid UTF-8, else all as base64;
    the key is decided on its own. A null field becomes the text ``null``, a null value an empty one of its type.
    A stream may have columns ``last_id`` and ``groups`` (as ``GROUPS``), whose names count among its byte strings.
    """
    empty = lambda name: F.coalesce(F.col(name), F.array().cast(VALUES[name]))
    pairs = F.concat(empty("fields"), F.flatten(F.transform(empty("entries"), lambda e: e["fields"])))
    strings = F.concat(
        F.array("text"), empty("members"), F.transform(pairs, lambda f: f["field"]), F.transform(pairs, lambda f: f["value"]),
        F.transform(empty("scored"), lambda m: m["member"]),
    )
    grouped = "groups" in records.columns
    if grouped:
        group_names = F.flatten(F.transform("groups", lambda g: F.concat(
            F.array(g["name"]), F.coalesce(g["consumers"], F.array().cast("array<binary>")), F.coalesce(F.transform(g["pending"], lambda p: p["consumer"]), F.array().cast("array<binary>")),
        )))
        strings = F.concat(strings, F.coalesce(group_names, F.array().cast("array<binary>")))
    with_mark = records.withColumn("_base64", F.exists(strings, lambda b: b.isNotNull() & ~is_text(b)))
    null = F.when(F.col("_base64"), F.lit("bnVsbA==")).otherwise(F.lit("null"))
    text = lambda b: F.coalesce(F.when(F.col("_base64"), base64_text(b)).otherwise(b.cast("string")), null)
    listed = lambda items, one: F.concat(F.lit("["), F.array_join(F.transform(items, one), ","), F.lit("]"))
    hashed = lambda fs: F.concat(F.lit("{"), F.array_join(F.transform(fs, lambda f: F.concat(quoted(text(f["field"])), F.lit(":"), quoted(text(f["value"])))), ","), F.lit("}"))
    kind = F.lower("type")
    body = (
        F.when(kind.isin("list", "set"), listed(empty("members"), lambda m: quoted(text(m)))).when(kind == "hash", hashed(empty("fields")))
        .when(kind == "zset", listed(empty("scored"), lambda m: F.to_json(F.struct(text(m["member"]).alias("member"), m["score"].alias("score")))))
        .when(kind == "stream", listed(empty("entries"), lambda e: F.concat(F.lit('{"id":'), quoted(e["id"]), F.lit(',"fields":'), hashed(e["fields"]), F.lit("}"))))
        .when(kind.isin("json", "rejson-rl"), F.coalesce(F.col("text").cast("string"), F.lit("null")))
        .otherwise(quoted(F.when(F.col("text").isNull(), "").otherwise(text(F.col("text")))))
    )
    key = F.col("key")
    head = F.to_json(F.struct(
        F.when(is_text(key), key.cast("string")).alias("key"), F.when(~is_text(key), base64_text(key)).alias("key_base64"),
        "type", "ttl_ms", F.when(F.col("_base64"), F.lit(True)).alias("base64"), *([F.col("last_id")] if "last_id" in records.columns else []),
        *([F.to_json(group_texts(F.col("groups"), lambda b: F.when(F.col("_base64"), base64_text(b)).otherwise(b.cast("string")))).alias("groups")] if grouped else []),
    ))
    return with_mark.select(F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"value":'), body, F.lit("}")).alias("line"))


def group_texts(groups: Column, change) -> Column:
    """Groups in the fields of ``GROUPS`` with ``change`` applied to every name."""
    return F.transform(groups, lambda g: F.struct(
        change(g["name"]).alias("name"), g["last_delivered_id"].alias("last_delivered_id"), g["entries_read"].cast("long").alias("entries_read"),
        F.transform(g["consumers"], change).alias("consumers"),
        F.transform(g["pending"], lambda p: F.struct(p["id"].alias("id"), change(p["consumer"]).alias("consumer"), p["delivered_at_ms"].alias("delivered_at_ms"), p["deliveries"].alias("deliveries"))).alias("pending"),
    ))


def from_typed_envelope(lines: DataFrame, groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records (key, type, ttl_ms and the columns of ``VALUES``) and bad lines (line, reason, and what other columns lines has); blank lines are skipped.

    With ``groups`` records have ``last_id`` and ``groups``, too; a line whose groups cannot be read is a bad one.
    """
    more = [c for c in lines.columns if c != "line"]
    r, kind, value = F.col("r"), F.lower("r.type"), F.col("r.value")
    raw = lines.filter(F.trim("line") != "").withColumn("r", F.from_json("line", LINE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    raw = raw.withColumns({
        "_members": F.when(kind.isin("list", "set"), F.from_json(value, "array<string>")),
        "_fields": F.when(kind == "hash", F.from_json(value, "map<string, string>")),
        "_scored": F.when(kind == "zset", F.from_json(value, "array<struct<member: string, score: double>>")),
        "_entries": F.when(kind == "stream", F.from_json(value, "array<struct<id: string, fields: map<string, string>>>")),
    })
    key = F.coalesce(F.encode("r.key", "UTF-8"), F.unbase64("r.key_base64"))
    parsed = F.when(kind.isin("list", "set"), F.col("_members").isNotNull()).when(kind == "hash", F.col("_fields").isNotNull())
    parsed = parsed.when(kind == "zset", F.col("_scored").isNotNull()).when(kind == "stream", F.col("_entries").isNotNull()).otherwise(value.isNotNull())
    reason = (
        F.when(r.isNull() | F.col("r._bad").isNotNull(), "not a JSON record").when(key.isNull(), "no key").when(F.col("r.type").isNull(), "no type")
        .when(~parsed, F.concat(F.lit("not the value of a "), kind))
    )
    bytes_of = lambda t: F.when(F.col("r.base64"), F.unbase64(t)).otherwise(F.encode(t, "UTF-8"))
    pairs = lambda m: F.transform(F.map_entries(m), lambda p: F.struct(bytes_of(p["key"]).alias("field"), bytes_of(p["value"]).alias("value")))
    document = kind.isin("json", "rejson-rl")
    own = {
        "text": F.when(document, F.encode(value, "UTF-8")).when(~kind.isin("list", "set", "hash", "zset", "stream"), bytes_of(value)),
        "members": F.transform("_members", bytes_of),
        "fields": pairs(F.col("_fields")),
        "scored": F.transform("_scored", lambda m: F.struct(bytes_of(m["member"]).alias("member"), m["score"].alias("score"))),
        "entries": F.transform("_entries", lambda e: F.struct(e["id"].alias("id"), pairs(e["fields"]).alias("fields"))),
    }
    if groups:
        told = F.from_json("r.groups", GROUPS.replace("binary", "string"))
        reason = F.coalesce(reason, F.when(F.col("r.groups").isNotNull() & told.isNull(), "not the groups of a stream"))
        own |= {"last_id": F.col("r.last_id"), "groups": group_texts(told, bytes_of)}
    seen = raw.withColumns({"reason": reason, "k": key})
    good = seen.filter("reason is null").select(F.col("k").alias("key"), "r.type", "r.ttl_ms", *(c.alias(n) for n, c in own.items()))
    return good, seen.filter("reason is not null").select("line", "reason", *more)


def field_ttl_commands(records: DataFrame, now_ms: Column, strategy: str = "PRESERVE", chunk: int = 1000) -> DataFrame:
    """(key, seq, argv) that rebuild hashes (key, ttl_ms, fields (field, value, expire_at_ms)) with the expiry of their fields.

    DEL, HSET in chunks, a HEXPIRE in whole seconds, rounded up, for each deadline that fields share (in chunks, too), then
    PEXPIRE. Fields whose deadline is past are left out; STRIP keeps every field and drops the deadlines.
    """
    none = F.array().cast("array<array<string>>")
    key, live = F.col("key"), project_field_ttls(F.col("fields"), now_ms, strategy)
    rows = records.select("key", "ttl_ms", live.alias("_f"))
    cut = lambda items: F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / chunk).cast("int")), lambda i: F.slice(items, i * chunk + 1, chunk))).otherwise(F.array().cast("array<array<struct<field:string,value:string,seconds:bigint>>>"))
    text = F.transform("_f", lambda f: F.struct(f["field"].cast("string").alias("field"), F.coalesce(f["value"].cast("string"), F.lit("null")).alias("value"), f["seconds"].cast("long").alias("seconds")))
    rows = rows.withColumn("_f", text)
    sets = F.transform(cut(F.col("_f")), lambda part: F.concat(F.array(F.lit("HSET"), key), F.flatten(F.transform(part, lambda f: F.array(f["field"], f["value"])))))
    times = F.array_sort(F.array_distinct(F.filter(F.transform("_f", lambda f: f["seconds"]), lambda s: s.isNotNull())))
    of = lambda s: cut(F.filter("_f", lambda f: f["seconds"] == s))
    one = lambda s, part: F.concat(F.array(F.lit("HEXPIRE"), key, s.cast("string"), F.lit("FIELDS"), F.size(part).cast("string")), F.transform(part, lambda f: f["field"]))
    expire = F.flatten(F.transform(times, lambda s: F.transform(of(s), lambda part: one(s, part))))
    commands = F.concat(F.array(F.array(F.lit("DEL"), key)), F.when(F.size("_f") > 0, F.concat(sets, expire, expiry(key))).otherwise(none))
    return rows.select("key", F.posexplode(commands).alias("seq", "argv"))


def expiry(key: Column) -> Column:
    """PEXPIRE as a list of commands, empty without an expiry."""
    none = F.array().cast("array<array<string>>")
    return F.when(F.col("ttl_ms") > 0, F.array(F.array(F.lit("PEXPIRE"), key, F.col("ttl_ms").cast("string")))).otherwise(none)


def document_commands(records: DataFrame) -> DataFrame:
    """(key, seq, argv) of JSON documents (key, ttl_ms, document): JSON.SET replaces the whole document, so nothing is deleted first."""
    key = F.col("key")
    commands = F.concat(F.array(F.array(F.lit("JSON.SET"), key, F.lit("."), F.col("document"))), expiry(key))
    return records.select("key", F.posexplode(commands).alias("seq", "argv"))


def stream_commands(records: DataFrame) -> DataFrame:
    """(key, seq, argv) of streams: key, ttl_ms, entries (id, fields (field, value)), last_id, groups.

    groups: array of (name, last_delivered_id, entries_read, consumers, pending (id, consumer, delivered_at_ms,
    deliveries)); one without a name goes, as does a consumer without one. Entries come first, then the groups, whose MKSTREAM makes a stream that has no
    entries left, then the last id where it is not that of the last entry, the consumers, and claims that restore
    pending entries with their time and count. Null entries or groups count as none.
    """
    key, none = F.col("key"), F.array().cast("array<array<string>>")
    shape = {f.name: f.dataType for f in records.schema.fields}
    entries = F.coalesce("entries", F.array().cast(shape["entries"]))
    groups = F.filter(F.coalesce("groups", F.array().cast(shape["groups"])), lambda g: g["name"].isNotNull())
    word, number = F.lit, lambda c: c.cast("string")
    command = lambda *words: F.array(*words)
    add = F.transform(entries, lambda e: F.concat(command(word("XADD"), key, e["id"]), F.flatten(F.transform(e["fields"], lambda f: F.array(f["field"], F.coalesce(f["value"], word("null")))))))
    since = lambda g: F.coalesce(g["last_delivered_id"], word("0"))
    made = F.flatten(F.transform(groups, lambda g: F.concat(
        F.array(command(word("XGROUP"), word("CREATE"), key, g["name"], since(g), word("MKSTREAM"))),
        F.when(g["entries_read"].isNotNull(), F.array(command(word("XGROUP"), word("SETID"), key, g["name"], since(g), word("ENTRIESREAD"), number(g["entries_read"])))).otherwise(none),
    )))
    newest = F.when(F.size(entries) > 0, F.element_at(entries, -1)["id"])
    moved = F.col("last_id").isNotNull() & ~F.col("last_id").eqNullSafe(newest) & ((F.size(entries) > 0) | (F.size(groups) > 0))
    last = F.when(moved, F.array(command(word("XSETID"), key, F.col("last_id")))).otherwise(none)
    names = lambda g: F.filter(g["consumers"], lambda c: c.isNotNull())
    readers = F.flatten(F.transform(groups, lambda g: F.coalesce(F.transform(names(g), lambda c: command(word("XGROUP"), word("CREATECONSUMER"), key, g["name"], c)), none)))
    claim = lambda g, p: command(
        word("XCLAIM"), key, g["name"], p["consumer"], word("0"), p["id"], word("TIME"), number(p["delivered_at_ms"]),
        word("RETRYCOUNT"), number(F.coalesce(p["deliveries"], F.lit(1))), word("FORCE"), word("JUSTID"),
    )
    claims = F.flatten(F.transform(groups, lambda g: F.coalesce(F.transform(g["pending"], lambda p: claim(g, p)), none)))
    commands = F.concat(F.array(command(word("DEL"), key)), add, made, last, readers, claims, expiry(key))
    return records.select("key", F.posexplode(commands).alias("seq", "argv"))


def merge_fields(records: DataFrame, column: str = "fields") -> DataFrame:
    """Hashes (key, type, array of field, value, perhaps expire_at_ms) in which a repeated field keeps its first place and its last value.

    The last expiry that is not null stays with a field. Fields are grouped on their own, so a hash of any size is
    aggregated in parts before its array is built again.
    """
    names = [n for n in records.schema[column].dataType.elementType.names if n != "field"]
    each = records.select("key", "type", F.posexplode_outer(column).alias("_at", "_f")).select("key", "type", "_at", "_f.*")
    kept = lambda n: F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_at")) if n == "expire_at_ms" else F.col("_at"))
    one = each.groupBy("key", "type", "field").agg(F.min("_at").alias("_at"), *(kept(n).alias(n) for n in names))
    row = F.when(F.col("_at").isNotNull(), F.struct("_at", "field", *names))
    again = one.groupBy("key", "type").agg(F.array_sort(F.collect_list(row)).alias("_all"))
    return again.select("key", "type", F.transform("_all", lambda f: F.struct(*(f[n].alias(n) for n in ["field", *names]))).alias(column))


def join_hash_chunks(chunks: DataFrame, waits: int = 0, max_waits: int = 10, order: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``join_chunks`` for hash chunks (key, type, chunk, chunks, fields): fields of the joined records are merged."""
    done, waiting, failed = join_chunks(chunks, "fields", waits, max_waits, order)
    return merge_fields(done), waiting, failed
