"""One way for records into a target, whatever they come from: hook, target name, write; with the same user code everywhere.

A hook sees every record that is written, of a copy, of live changes, of repairs and of imported files. It does
not see deletions, nor module types, which are moved as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.keys import CORE_TYPES, KeyNames
from keyloom.operators import sync
from keyloom.operators.buckets import BucketedTarget

HOOKED = (*CORE_TYPES, "json", "rejson-rl")


def innermost(error: BaseException) -> str:
    """Text of the first cause."""
    while error.__cause__ or error.__context__:
        error = error.__cause__ or error.__context__
    return str(error) or type(error).__name__


def record_hook(fn: Callable[[dict], dict | None]) -> Callable[[DataFrame], DataFrame]:
    """A hook of a function of one record: it returns the record, changed or not, or None to drop it.

    What it raises becomes that record's ``reason`` and leaves the others alone; the record stays as it was. A
    column that it leaves out is null, one that the records do not have is an error.
    """

    def hook(records: DataFrame) -> DataFrame:
        names = records.columns

        def one(row: dict) -> dict | None:
            try:
                out = fn(dict(row))
                if out is None:
                    return None
                if unknown := set(out) - set(names):
                    raise ValueError(f"the hook returned unknown columns: {', '.join(sorted(unknown))}")
                if out.get("key") is None:
                    raise ValueError("the hook returned a record without a key")
                return {n: out.get(n) for n in names} | {"reason": None}
            except Exception as e:  # noqa: BLE001 - user code
                return row | {"reason": innermost(e)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                kept = [r for r in map(one, b.to_pylist()) if r is not None]
                yield pa.RecordBatch.from_pylist(kept, b.schema.append(pa.field("reason", pa.string())))

        return records.mapInArrow(run, records.withColumn("reason", F.lit(None).cast("string")).schema)

    return hook


@dataclass(frozen=True)
class Flow:
    """How records become writes: ``hook`` (a DataFrame -> DataFrame, see ``record_hook``), ``names``, ``types`` in scope, ``conflict``."""

    hook: Callable[[DataFrame], DataFrame] | None = None
    names: KeyNames = KeyNames()
    types: tuple[str, ...] = ()
    conflict: str = "OVERWRITE"

    def prepared(self, records: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Records under their target names, and failures (key, reason) of the hook and of names."""
        failed = None
        if self.hook:
            seen = F.lower("type").isin(*HOOKED)
            out = sync.with_hook(records.filter(seen), self.hook)
            good, bad = sync.route(out)
            records, failed = good.select(*records.columns).unionByName(records.filter(~seen)), bad.select("key", "reason")
        named, nameless = sync.mapped(records, self.names)
        return named, nameless if failed is None else failed.unionByName(nameless)

    def write(self, records: DataFrame, target: DataFrame, order: list[str] = ()) -> tuple[DataFrame, DataFrame]:
        """The new target, and an outcome (key, outcome, reason) of every record: success, skipped or failure."""
        ready, failed = self.prepared(records)
        new, outcomes = sync.upsert(ready, target, self.conflict, order)
        return new, outcomes.unionByName(failed.select("key", F.lit("failure").alias("outcome"), "reason"))

    def copy(self, source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
        from keyloom.functions.keys import allows_type

        return self.write(source.filter(allows_type(F.col("type"), list(self.types))), target)

    def live(self, changed: DataFrame, source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Current values of changed keys, or their deletion; what exists is replaced whatever ``conflict`` says."""
        return Flow(self.hook, self.names, self.types).write(sync.current_values(changed, source, list(self.types)), target)

    def repair(self, diffs: DataFrame, source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Keys of differences, under their source names, copied again or deleted."""
        return self.live(diffs, source, target)

    def ingest(self, records: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Records of files; without an order repeated keys should be equal."""
        return self.write(records, target)

    def apply_batch(self, changed: DataFrame, source: DataFrame, target: BucketedTarget, number: int) -> tuple[DataFrame, DataFrame]:
        """A micro-batch into a table of buckets; outcomes of its keys, and failures (key, reason)."""
        ready, failed = self.prepared(sync.current_values(changed, source, list(self.types)))
        return target.apply(ready, number), failed
