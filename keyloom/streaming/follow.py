"""Following shards: changed keys once while they wait, full listings by generation, and positions that may be saved.

A stream has rows (shard, kind, generation, offset, key):

- ``resync``: a full listing of the shard's keys begins, of a state no older than ``offset``; it voids an older one, and
  changes of an older generation that come after it. Keys that wait are sent again, as they may be gone and not be listed
- ``listed``: a key of that listing; ``complete``: the listing is over
- ``change``: a key was changed by what ends at ``offset``
- ``done``: the key, as it was when it was sent with this ``offset``, stands in the target

A changed key is sent once and then waits for its ``done``; changes meanwhile make one more sending after it. A
shard's position may be saved once its listing is over and all of its keys are done, and then reaches up
to the first change that is not. Whoever restarts there meets every change again that could be missing;
since the current values of keys are written, what was there already is only written again.

Keys are dealt to ``parts`` by a hash, so that a shard with a large share of all keys is followed by many
tasks; rows that concern a whole shard go to all of its parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from keyloom.operators.buckets import BucketedTarget

ROWS = "shard string, kind string, generation long, offset long, key string"
OUT = "shard string, part int, kind string, generation long, key string, offset long, read long, ready boolean"
POSITIONS = "key string, type string, shard string, part int, generation long, offset long, read long, ready boolean"
ORDER = {"done": 0, "resync": 1, "listed": 2, "change": 2, "complete": 3}


class ShardPart(StatefulProcessor):
    """State of one part of a shard: the generation, whether its listing is over, where it began, how far it was read; and the keys that wait."""

    def init(self, handle) -> None:
        self.at = handle.getValueState("at", "generation long, listed boolean, base long, read long")
        # first and last offset at which the key was changed and is not done, and the offset it was sent with
        self.waiting = handle.getMapState("waiting", "key string", "first long, last long, sent long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        shard, part = key
        generation, listed, base, read = self.at.get() if self.at.exists() else (-1, True, -1, -1)
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.assign(_kind=batch["kind"].map(ORDER)).sort_values(["generation", "_kind", "offset"], kind="stable")
        batch = pd.concat([batch[batch["_kind"] == 0], batch[batch["_kind"] > 0]])  # what is done was sent before
        send: dict[str, int] = {}
        newest = batch["generation"].max()
        for r in batch.itertuples(index=False):
            g, offset = int(r.generation), int(r.offset)
            if r.kind == "done":
                if g == generation and self.waiting.containsKey((r.key,)):  # what an older generation sent was sent again
                    first, last, sent = self.waiting.getValue((r.key,))
                    if offset >= last:
                        self.waiting.removeKey((r.key,))
                    elif offset >= sent:  # changed since
                        self.waiting.updateValue((r.key,), (max(first, offset + 1), last, last))
                        send[r.key] = last
                continue
            if g < generation or (g < newest and r.kind == "listed"):  # of a history or a listing that is void
                continue
            if g > generation:
                if generation >= 0 or r.kind == "resync":
                    listed, base, read = False, offset, offset
                    for (k,), (_, _, sent) in list(self.waiting.iterator()):  # may be gone since and not be listed; offsets begin anew
                        self.waiting.updateValue((k,), (offset, offset, min(sent, offset - 1)))
                        send[k] = offset
                generation = g
            if r.kind == "complete":
                listed = True
            elif r.kind in ("listed", "change"):
                at = base if r.kind == "listed" else offset
                read = max(read, at)
                if self.waiting.containsKey((r.key,)):
                    first, last, sent = self.waiting.getValue((r.key,))
                    self.waiting.updateValue((r.key,), (min(first, at), max(last, at), sent))
                    if r.key in send:
                        send[r.key] = max(last, at)
                else:
                    self.waiting.updateValue((r.key,), (at, at, at))
                    send[r.key] = at
        for k, at in send.items():
            first, last, _ = self.waiting.getValue((k,))
            self.waiting.updateValue((k,), (first, last, at))
        self.at.update((generation, listed, base, read))
        firsts = [first for _, (first, _, _) in self.waiting.iterator()]
        ready = listed and (not firsts or min(firsts) > base)
        sent_rows = [(shard, part, "emit", generation, k, at, None, None) for k, at in send.items()]
        own = (shard, part, "position", generation, None, min(firsts) - 1 if firsts else None, read, ready)
        yield pd.DataFrame([*sent_rows, own], columns=[c.split()[0] for c in OUT.split(", ")]).astype({"offset": "Int64", "read": "Int64", "ready": "boolean"})

    def close(self) -> None:
        pass


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Rows with ``part``: by a hash of the key; rows of a whole shard in every part."""
    own = F.array(F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    everywhere = F.sequence(F.lit(0), F.lit(parts - 1))
    return rows.withColumn("part", F.explode(F.when(F.col("kind").isin("resync", "complete"), everywhere).otherwise(own)))


def follow(rows: DataFrame, parts: int = 8) -> DataFrame:
    """Keys to send (kind ``emit``: key, offset) and how far each part is (``position``: offset before the first change that waits, read, ready)."""
    return dealt(rows, parts).groupBy("shard", "part").transformWithStateInPandas(ShardPart(), outputStructType=OUT, outputMode="Append", timeMode="None")


def saveable(positions: DataFrame) -> DataFrame:
    """shard, generation, offset: where each shard may be restarted, from the last ``position`` row of each of its parts; null as long as its listing is not over."""
    by = positions.groupBy("shard").agg(F.max("generation").alias("generation"), F.bool_and("ready").alias("ready"), F.min("offset").alias("low"), F.max("read").alias("read"))
    return by.select("shard", "generation", F.when(F.col("ready"), F.coalesce("low", "read")).alias("offset"))


def position_table(spark, path: str) -> BucketedTarget:
    """A table of the last position of every part; each micro-batch is one commit."""
    return BucketedTarget.create(spark.createDataFrame([], POSITIONS), path, buckets=1)


def start(rows: DataFrame, apply: Callable[[DataFrame, int], DataFrame | None], positions: BucketedTarget, checkpoint: str, parts: int = 8):
    """Start following: each micro-batch gives its keys (shard, part, generation, key, offset) to ``apply``, then saves the positions.

    A batch that is replayed gives the same keys again and leaves the positions as they are.
    """

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            apply(df.filter("kind = 'emit'").select("shard", "part", "generation", "key", "offset"), number)
            own = F.concat_ws("/", "shard", "part")
            positions.apply(df.filter("kind = 'position'").select(own.alias("key"), F.lit("position").alias("type"), *POSITIONS_OF), number)
        finally:
            df.unpersist()

    return follow(rows, parts).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


POSITIONS_OF = ("shard", "part", "generation", "offset", "read", "ready")


def saveable_offsets(changes: DataFrame, done: DataFrame) -> DataFrame:
    """The batch form: shard, offset. changes: shard, offset, key; done: key, offset (what has been written of it).

    A shard's position reaches up to the first change whose key has not been written with that offset or a later one.
    """
    written = done.groupBy("key").agg(F.max("offset").alias("_done"))
    waits = changes.join(written, "key", "left").withColumn("_waits", F.col("_done").isNull() | (F.col("_done") < F.col("offset")))
    return waits.groupBy("shard").agg(F.coalesce(F.min(F.when(F.col("_waits"), F.col("offset") - 1)), F.max("offset")).alias("offset"))
