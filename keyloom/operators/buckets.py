"""A target that is changed in place of being rewritten: hash buckets of base and delta files behind a versioned manifest.

``data/commit=<n>/bucket=<b>`` holds what commit n wrote into bucket b, and is never changed. The manifest is
a table of which a commit appends one file, as its last step: what a commit wrote counts from then on, and
all of it. A bucket's content is its newest base and the deltas after it, the newest record of each key. A
commit writes into the buckets of its keys only; ``compact`` folds the deltas of a bucket into a new base.
There is one writer at a time; readers see the version that they began with.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from keyloom.operators import sync

MANIFEST = "version long, batch long, kind string, bucket int, rows long"
OUTCOMES = "key string, outcome string, reason string"


class BucketedTarget:
    """Records (key, type, ...) of one schema below ``path``, in ``buckets`` by a hash of the key.

    ``spread`` cuts what a commit writes into a bucket into so many files, for loads whose buckets are too large
    for one task. Both numbers belong to the table: give the same ones whenever it is opened.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, buckets: int = 256, spread: int = 1):
        self.spark, self.path, self.schema, self.buckets, self.spread = spark, path.rstrip("/"), schema, buckets, spread

    @classmethod
    def create(cls, records: DataFrame, path: str, buckets: int = 256, spread: int = 1) -> BucketedTarget:
        """A new table that holds these records; keys must be distinct."""
        table = cls(records.sparkSession, path, records.schema, buckets, spread)
        table.commit(records, 0, None, "base")
        return table

    def manifest(self) -> DataFrame:
        """version, batch, kind (base, delta or nothing), bucket, rows: what each commit wrote."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")

    def bucket(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def commit(self, rows: DataFrame, version: int, batch: int | None, kind: str, also: list[int] = ()) -> None:
        """Write rows, then the manifest's file, which names the buckets ``also``, too, if nothing is left of them.

        A folder that an interrupted commit of this version left is replaced.
        """
        folder = f"{self.path}/data/commit={version}"
        dealt = rows.withColumns({"bucket": self.bucket(), "_file": F.pmod(F.xxhash64("key", F.lit(1)), F.lit(self.spread))})
        dealt.repartition("bucket", "_file").drop("_file").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        there = self.spark.read.schema(StructType([*self.schema.fields]).add("bucket", IntegerType())).parquet(folder)
        written = there.groupBy("bucket").agg(F.count("*").alias("rows")).select(F.lit(kind).alias("kind"), "bucket", "rows")  # a row a bucket
        named = [(kind, b, 0) for b in also] + [("nothing", None, 0)]  # the commit itself, rows or none
        mark = self.spark.createDataFrame(named, "kind string, bucket int, rows long")
        line = written.unionByName(mark).groupBy("kind", "bucket").agg(F.max("rows").alias("rows")).select(F.lit(version).cast("long").alias("version"), F.lit(batch).cast("long").alias("batch"), "kind", "bucket", "rows")
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def version(self) -> int:
        return self.manifest().agg(F.max("version")).first()[0]

    def live(self, version: int | None = None, buckets: list[int] | None = None) -> list[tuple[int, int, str]]:
        """(commit, bucket, kind) of the folders that hold these buckets: the newest base and what came after it."""
        seen = self.manifest().filter("kind <> 'nothing'")
        if version is not None:
            seen = seen.filter(F.col("version") <= version)
        if buckets is not None:
            seen = seen.filter(F.col("bucket").isin(buckets))
        base = seen.filter("kind = 'base'").groupBy("bucket").agg(F.max("version").alias("_base"))
        live = seen.join(F.broadcast(base), "bucket", "left").filter("rows > 0 and (_base is null or version >= _base)")  # a row a bucket
        return sorted((r["version"], r["bucket"], r["kind"]) for r in live.select("version", "bucket", "kind").collect())  # compaction bounds their number

    def parts(self, version: int | None = None, buckets: list[int] | None = None) -> list[tuple[int, int]]:
        return [(v, b) for v, b, _ in self.live(version, buckets)]

    def read(self, version: int | None = None, buckets: list[int] | None = None, tombstones: bool = False) -> DataFrame:
        """The records, of these buckets alone if they are given, as of a version (the newest by default)."""
        parts = self.parts(version, buckets)
        shape = StructType([*self.schema.fields]).add("commit", LongType()).add("bucket", IntegerType())
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(shape).option("basePath", f"{self.path}/data").parquet(*(f"{self.path}/data/commit={c}/bucket={b}" for c, b in parts))
        if len({b for _, b in parts}) < len(parts):  # some bucket has deltas
            rows = rows.groupBy("key").agg(F.max_by(F.struct(*self.schema.names), "commit").alias("_r")).select("_r.*")
        return (rows if tombstones else rows.filter("type <> 'deleted'")).select(*self.schema.names)

    def apply(self, records: DataFrame, batch: int, conflict: str = "OVERWRITE", order: list[str] = ()) -> DataFrame:
        """Upsert records as ``sync.upsert`` does, ``deleted`` ones remove their key; (key, outcome, reason) of each key.

        A batch that was committed before changes nothing and has no outcomes. Records and outcomes must not change
        when they are computed twice. Only SKIP and FAIL read the target, and of it the buckets of the batch.
        """
        last = self.manifest().agg(F.max("version").alias("v"), F.max(F.col("batch") == batch).alias("seen")).first()
        if last["seen"]:
            return self.spark.createDataFrame([], OUTCOMES)
        newest = sync.newest(records, list(order), self.schema.names)
        if conflict == "OVERWRITE":
            done, outcomes = newest, newest.select("key", F.lit("success").alias("outcome"), F.lit(None).cast("string").alias("reason"))
        else:
            touched = [r[0] for r in newest.select(self.bucket()).distinct().collect()]  # ``buckets`` numbers at most
            done, outcomes = sync.decided(newest, self.read(last["v"], touched), conflict)
        self.commit(done.select(*self.schema.names), last["v"] + 1, batch, "delta")
        return outcomes

    def compact(self, most: int = 8) -> int:
        """Fold the deltas of every bucket that has more than ``most`` of them; how many buckets that were."""
        deltas = Counter(b for _, b, kind in self.live() if kind == "delta")
        full = [b for b, n in deltas.items() if n > most]
        if full:
            self.commit(self.read(buckets=full), self.version() + 1, None, "base", full)
        return len(full)

    def dead(self) -> list[str]:
        """Folders that the newest version does not read; they may be removed when no reader of an older one is left."""
        live = set(self.parts())
        past = self.manifest().filter("rows > 0").select("version", "bucket").collect()  # as many as ``parts`` since they were last removed
        return sorted(f"{self.path}/data/commit={r['version']}/bucket={r['bucket']}" for r in past if (r["version"], r["bucket"]) not in live)
