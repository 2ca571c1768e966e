"""Watching a run: drift of the topology as a stream, and counters that a stream leaves in a table of its history."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQueryListener

DRIFT = "run_id string, snapshot_id string, joined long, departed long, reassigned long, severity string"


class Baseline(StatefulProcessor):
    """The last snapshot of a run; each newer one is compared with it and takes its place, an older one is refused."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "snapshot_id string, nodes string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        snapshots: dict[str, dict[str, list[int]]] = {}
        for b in rows:
            for r in b.itertuples(index=False):
                snapshots.setdefault(r.snapshot_id, {})[r.node_id] = sorted(int(x) for x in r.slots)
        at, before = self.last.get() if self.last.exists() else (None, "{}")
        before, out = json.loads(before), []
        for name in sorted(snapshots):
            now = snapshots[name]
            if at is not None and name <= at:
                out.append((key[0], name, None, None, None, "REFUSED"))
                continue
            if at is not None:
                joined, departed = len(now.keys() - before.keys()), len(before.keys() - now.keys())
                moved = sum(now[n] != before[n] for n in now.keys() & before.keys())
                out.append((key[0], name, joined, departed, moved, "CRITICAL" if joined else "ADVISORY" if departed or moved else "NONE"))
            at, before = name, now
        self.last.update((at, json.dumps(before)))
        yield pd.DataFrame(out, columns=["run_id", "snapshot_id", "joined", "departed", "reassigned", "severity"]).astype({c: "Int64" for c in ("joined", "departed", "reassigned")})

    def close(self) -> None:
        pass


def drift_alerts(snapshots: DataFrame) -> DataFrame:
    """Drift of every snapshot of a stream (run_id, snapshot_id, node_id: strings, slots array<int>) against the run's one before, as ``topology.drift`` has it.

    Snapshots are ordered by id as text, and all rows of one come in one micro-batch. One that is not newer than the
    baseline is REFUSED and leaves it as it is.
    """
    return snapshots.groupBy("run_id").transformWithStateInPandas(Baseline(), outputStructType=DRIFT, outputMode="Append", timeMode="None")


HISTORY = "run_id string, batch long, name string, value long"
PREFIX = "keyloom_"


def counted(df: DataFrame, run_id: str, **counters: Column) -> DataFrame:
    """df, which leaves the number of rows for which each condition holds with whoever listens, as it passes by, without a pass of its own."""
    return df.observe(f"{PREFIX}{run_id}", *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counters.items()))


class RunHistory(StreamingQueryListener):
    """Collects the counters of ``counted`` streams; ``save`` appends them to a table (run_id, batch, name, value)."""

    def __init__(self):
        self.seen: dict[tuple[str, int], dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            if name.startswith(PREFIX):
                self.seen[name.removeprefix(PREFIX), event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def save(self, spark: SparkSession, path: str) -> None:
        """Append what was collected since the last time. A batch that is replayed is there twice: ``totals`` counts its last report."""
        rows = [(run, batch, name, int(value)) for (run, batch), row in self.seen.items() for name, value in row.items()]
        self.seen.clear()
        if rows:
            spark.createDataFrame(rows, HISTORY).coalesce(1).write.mode("append").parquet(path)


def totals(history: DataFrame) -> DataFrame:
    """run_id, name, total over the batches of a history."""
    return history.groupBy("run_id", "batch", "name").agg(F.max("value").alias("value")).groupBy("run_id", "name").agg(F.sum("value").alias("total"))
