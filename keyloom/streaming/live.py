"""The live phase with Structured Streaming: apply changes, wait for chunks, retry with hold, watch drift."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from keyloom.functions.keys import KeyNames
from keyloom.operators import sync
from keyloom.operators.buckets import BucketedTarget
from keyloom.operators.flow import Flow


def coalesce_changes(changes: DataFrame, delay: str | None = None) -> DataFrame:
    """Each changed key once a micro-batch; with a watermark delay on ``ts`` also across batches, in bounded state."""
    return changes.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["key"]) if delay else changes.dropDuplicates(["key"])


def apply_batch(changed: DataFrame, source: DataFrame, target: DataFrame, names: KeyNames = KeyNames(), types: list[str] = (), hook=None) -> tuple[DataFrame, DataFrame]:
    """One micro-batch: current values of the changed keys go to the target under their target names. (target, failures)."""
    ready, failed = Flow(hook, names, tuple(types)).prepared(sync.current_values(changed, source, types))
    return sync.upsert(ready, target)[0], failed


def apply_changes(
    changes: DataFrame, source: Callable[[], DataFrame], target: BucketedTarget, checkpoint: str, flow: Flow = Flow(),
    dead: Callable[[DataFrame, int], None] | None = None, compact: int = 8, **trigger,
):
    """Start the live apply of a stream of changed keys (key) to a table of buckets; each micro-batch is one commit.

    A batch writes into the buckets of its keys alone. One that is replayed after a failure changes nothing, as its
    number is in the manifest; the checkpoint moves on only when a batch is written. Buckets with more than
    ``compact`` deltas are folded. ``trigger`` is that of the stream, all that is there by default.
    """

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            _, failed = flow.apply_batch(coalesce_changes(df.select("key")), source(), target, number)
            if dead:
                dead(failed, number)
            target.compact(compact)
        finally:
            df.unpersist()

    return changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()


class ChunkWait(StatefulProcessor):
    """Holds the chunks of a key until all are there; gives up after so many waits. A later set of the key begins anew.

    Of the timers of a key the one that ``due`` names counts; others belong to sets that are finished.
    """

    def __init__(self, wait_ms: int, most: int):
        self.wait_ms, self.most = wait_ms, most

    def init(self, handle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "chunk int", "content string, chunks int, type string")
        self.waits = handle.getValueState("waits", "n int, due long")

    def wait(self, n: int, now: int) -> None:
        self.waits.update((n, now + self.wait_ms))
        self.handle.registerTimer(now + self.wait_ms)

    def clear(self) -> None:
        self.parts.clear()
        self.waits.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for b in rows:
            for r in b.itertuples(index=False):
                if not self.parts.containsKey((int(r.chunk),)):  # the first of a repeated chunk counts
                    content = [[f["field"], f["value"]] for f in r.fields] if r.type == "hash" else list(r.items)
                    self.parts.updateValue((int(r.chunk),), (json.dumps(content), int(r.chunks), r.type))
        held = {k[0]: v for k, v in self.parts.iterator()}
        _, chunks, kind = held[min(held)]
        if len(held) == chunks:
            self.clear()
            content = [x for i in sorted(held) for x in json.loads(held[i][0])]
            items, fields = (None, [{"field": f, "value": v} for f, v in dict(content).items()]) if kind == "hash" else (content, None)
            yield pd.DataFrame({"key": [key[0]], "type": [kind], "items": [items], "fields": [fields], "reason": [None]})
        elif not self.waits.exists():
            self.wait(0, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.waits.exists():
            return
        n, due = self.waits.get()
        if expiredTimerInfo.getExpiryTimeInMs() != due:
            return
        if n + 1 < self.most:
            self.wait(n + 1, due)
            return
        held = [v for _, v in self.parts.iterator()]
        self.clear()
        reason = f"only {len(held)} of the key's {held[0][1]} chunks arrived"
        yield pd.DataFrame({"key": [key[0]], "type": [None], "items": [None], "fields": [None], "reason": [reason]})

    def close(self) -> None:
        pass


PAIRS = "array<struct<field: string, value: string>>"


def await_chunks(chunks: DataFrame, wait_ms: int = 60_000, most: int = 10) -> DataFrame:
    """Whole records (key, type, items, fields), or a reason, of a stream of chunks (key, type, chunk, chunks, and items array<string> or,
    of a hash, fields). A set is given up after ``most`` waits of ``wait_ms``. Of a hash's repeated field the last value
    counts, at its first place. Needs the RocksDB state store."""
    have = {"items": "array<string>", "fields": PAIRS}
    rows = chunks.select("key", "type", "chunk", "chunks", *(F.col(n) if n in chunks.columns else F.lit(None).cast(t).alias(n) for n, t in have.items()))
    return rows.groupBy("key").transformWithStateInPandas(
        ChunkWait(wait_ms, most), outputStructType=f"key string, type string, items array<string>, fields {PAIRS}, reason string", outputMode="Append", timeMode="ProcessingTime"
    )


class RetryHold(StatefulProcessor):
    """A failed write is tried again after a growing delay; newer writes of its key wait behind it.

    Until the retry goes out a newer write takes its place. From then on newer writes wait, and the newest one goes out
    when the retry's outcome is there, or when ``hold_ms`` have passed since the retry was due. A row that has not
    failed is a new write if its ``tries`` is 0, else the success of a retry.
    """

    def __init__(self, most: int, base_ms: int, longest_ms: int, hold_ms: int):
        self.most, self.base_ms, self.longest_ms, self.hold_ms = most, base_ms, longest_ms, hold_ms

    def init(self, handle) -> None:
        self.handle = handle
        # what waits, its tries, whether the retry is out, whether something newer waits behind it, when the next step is due
        self.waiting = handle.getValueState("waiting", "seq long, value string, tries int, out boolean, newer boolean, due long")

    def plan(self, seq: int, value: str, tries: int, out: bool, due: int) -> None:
        self.waiting.update((seq, value, tries, out, False, due))
        self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, found = timerValues.getCurrentProcessingTimeInMs(), []
        for b in rows:
            for r in b.sort_values("seq").itertuples(index=False):
                seq, tries = int(r.seq), int(r.tries)
                held = self.waiting.get() if self.waiting.exists() else None
                last, value, count, out, newer, due = held or (None, None, 0, False, False, 0)
                if r.failed and tries >= self.most:
                    found.append((key[0], seq, r.value, tries + 1, "gave up"))
                    if out:
                        self.waiting.clear()
                        if newer:
                            found.append((key[0], last, value, 0, "write"))
                elif r.failed:
                    if held is None or (seq >= last and not newer):
                        last, value = seq, r.value
                    elif not out:
                        continue
                    self.plan(last, value, tries + 1, False, now + min(self.longest_ms, self.base_ms * 2**tries))
                elif held is None:
                    if tries == 0:
                        found.append((key[0], seq, r.value, 0, "write"))
                elif tries == 0:
                    if seq > last:
                        self.waiting.update((seq, r.value, count, out, out, due))
                elif out:
                    self.waiting.clear()
                    if newer:
                        found.append((key[0], last, value, 0, "write"))
        yield pd.DataFrame(found, columns=["key", "seq", "value", "tries", "action"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.waiting.exists():
            return
        seq, value, tries, out, newer, due = self.waiting.get()
        if expiredTimerInfo.getExpiryTimeInMs() < due:  # of a step that another one has replaced
            return
        if out:
            self.waiting.clear()
        else:
            self.plan(seq, value, tries, True, due + self.hold_ms)
        if newer or not out:
            yield pd.DataFrame([(key[0], seq, value, 0 if out else tries, "write")], columns=["key", "seq", "value", "tries", "action"])

    def close(self) -> None:
        pass


def retry_with_hold(outcomes: DataFrame, most: int = 5, base_ms: int = 100, longest_ms: int = 30_000, hold_ms: int = 600_000) -> DataFrame:
    """(key, seq, value, tries, action write or gave up) of a stream of writes and outcomes (key, seq, value, tries, failed)."""
    return outcomes.groupBy("key").transformWithStateInPandas(
        RetryHold(most, base_ms, longest_ms, hold_ms), outputStructType="key string, seq long, value string, tries int, action string", outputMode="Append", timeMode="ProcessingTime"
    )


def retry_delay_ms(tries, base_ms: int = 100, longest_ms: int = 30_000, spread: float = 0.2):
    """Delay before a try as a column: doubling up to a limit, spread by a hash of the key so that runs repeat."""
    jitter = 1 + spread * (F.pmod(F.xxhash64("key", tries), F.lit(2001)) / 1000 - 1)
    return F.least(F.lit(longest_ms), base_ms * F.pow(F.lit(2), tries - 1)) * jitter
