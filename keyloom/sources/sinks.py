"""Sinks: JSON-lines backups and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.keys import CORE_TYPES
from keyloom.functions.structured import VALUES, join_hash_chunks, to_typed_envelope
from keyloom.functions.values import join_chunks, to_envelope


def write_key_records(records: DataFrame, path: str, chunks: DataFrame | None = None) -> DataFrame:
    """Write core-typed records as JSON lines, all or nothing; returns the rejected keys with a reason.

    records: key, type, ttl_ms and either ``value`` (bytes) or columns of ``structured.VALUES``. ``chunks`` (key, type,
    ttl_ms, chunk, chunks, and ``fields`` or ``members``) are joined first; keys whose chunks are not all there are rejected.
    """
    typed = any(c in VALUES for c in records.columns)
    rejected = None
    if chunks is not None:
        records, rejected = joined(records, chunks)
    core = F.lower("type").isin(*CORE_TYPES, "json", *(["rejson-rl"] if typed else []))
    good = records.filter(core)
    (to_typed_envelope(with_values(good)) if typed else to_envelope(good)).write.text(path)
    other = records.filter(~core).select("key", F.concat(F.lit("a backup cannot hold "), F.col("type")).alias("reason"))
    return other if rejected is None else other.unionByName(rejected)


def with_values(records: DataFrame) -> DataFrame:
    """Typed records with every column of ``VALUES``; those they do not have are null."""
    more = [n for n in ("last_id", "groups") if n in records.columns]  # of streams
    return records.select("key", "type", "ttl_ms", *(F.col(n) if n in records.columns else F.lit(None).cast(t).alias(n) for n, t in VALUES.items()), *more)


def joined(records: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and what complete chunks make; keys of the others with a reason. Of a repeated chunk the first by its content counts."""
    parts, failed = [], []
    for kind, column in (("hash", "fields"), ("list", "members")):
        if column in chunks.columns:
            own = chunks.filter(F.lower("type") == kind)
            done, _, bad = (join_hash_chunks if kind == "hash" else lambda c, *a: join_chunks(c, "members", *a))(own, 10, 10)
            ttl = own.groupBy("key").agg(F.max("ttl_ms").alias("ttl_ms"))
            parts.append(with_values(done.join(ttl, "key")))
            failed.append(bad)
    out, bad = with_values(records), failed[0]
    for p in parts:
        out = out.unionByName(p, allowMissingColumns=True)
    for f in failed[1:]:
        bad = bad.unionByName(f)
    return out, bad


def report(diffs: DataFrame, checked: int, mode: str, trigger: str, examples: int = 100) -> DataFrame:
    """One row: mode, trigger, checked, total, counts by reason and the first examples."""
    first = diffs.orderBy("key", "reason").limit(examples).agg(F.array_sort(F.collect_list(F.struct("key", "reason"))).alias("examples"))
    by = diffs.groupBy("reason").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("counts")
    )
    head = diffs.sparkSession.range(1).select(F.lit(mode).alias("mode"), F.lit(trigger).alias("trigger"), F.lit(checked).cast("long").alias("checked"))
    return head.join(by, how="cross").join(first, how="cross")  # one row each


def report_lines(one: DataFrame, fmt: str = "json") -> DataFrame:
    """The report as text rows (line), JSON or Markdown."""
    if fmt == "json":
        return one.select(F.to_json(F.struct(*one.columns)).alias("line"))
    counts = F.transform(F.map_entries("counts"), lambda e: F.concat(F.lit("| "), e["key"], F.lit(" | "), e["value"].cast("string"), F.lit(" |")))
    shown = F.transform("examples", lambda e: F.concat(F.lit("- `"), e["key"], F.lit("`: "), e["reason"]))
    head = F.array(
        F.concat(F.lit("# Reconcile pass ("), "mode", F.lit(")")), F.concat(F.lit("Trigger: "), "trigger"),
        F.format_string("%d keys checked, %d differences", "checked", "total"), F.lit("| reason | keys |"), F.lit("|---|---|"),
    )
    return one.select(F.explode(F.concat(head, counts, shown)).alias("line"))


def write_report(one: DataFrame, path: str, fmt: str = "json") -> None:
    report_lines(one, fmt).coalesce(1).write.text(path)


def write_validation(checks: DataFrame, path: str, fmt: str = "json") -> None:
    """Validation results as JSON lines or as CSV without quoting."""
    (checks.write.json(path) if fmt == "json" else checks.write.option("header", True).option("quote", "").csv(path))
