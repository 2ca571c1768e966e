"""What the operators share: checkpoints in the shared folder and ids for rows."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.session import checkpointed, ensure_checkpoint_dir

__all__ = ["checkpointed", "exact", "exact_longs", "few", "freed", "perhaps", "row_ids", "row_key", "small_batches", "written"]


@contextlib.contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files; else those stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame) -> DataFrame:
    """Write as Parquet below the shared checkpoint folder and read back: compact, and survives executors. Its shuffle files go."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    with freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: str = "4m") -> None:
    """Python tasks of this session get at most so many bytes of rows at a time, unless the application names a limit itself.

    A batch is held several times over, by the JVM, as Arrow and as Python strings; results do not depend on its size.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, most)


def few(df: DataFrame, most: int) -> DataFrame:
    """df marked for broadcast if it has at most ``most`` rows, which is counted first; as it is beyond that, and joins shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def perhaps(df: DataFrame, name: str, keys: DataFrame, how: str = "left_semi", most: int = 1 << 18) -> DataFrame:
    """The rows of df whose ``name`` (a 64-bit hash) may be in the one column of keys; where ``how`` is left_anti, those where it surely is not.

    Bits of the keys are broadcast, in at most ``most`` words of 64 bits (a power of two), so that rows are parted before a shuffle.
    Up to ``most`` keys some 1.5 % of the other rows are taken for theirs, more beyond that: an exact join has to follow.
    """
    words = 1 << max(0, min(keys.count(), most) - 1).bit_length()
    parts = lambda c: (c.bitwiseAND(words - 1), F.shiftrightunsigned(c, 58).cast("int"))
    word, bit = parts(F.col(keys.columns[0]))
    bits = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    word, bit = parts(F.col(name))
    return df.join(F.broadcast(bits), (word == F.col("_word")) & (F.getbit("_bits", bit) == 1), how)


def row_ids() -> Iterator[int]:
    """Ids for the rows of a task, the same when the task runs again over the same split."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 36
    n = 0
    while True:
        yield base + n
        n += 1


def row_key(*names: str) -> Column:
    """64-bit hash of a row's values in these columns, nulls told apart; n distinct rows have about n^2 / 2^65 false matches."""
    return F.xxhash64(*(F.col(n).isNull() for n in names), *names)


def exact(name: str = "doc_id") -> tuple[Column, Column]:
    """A nullable long as two columns without nulls, ``name`` and ``no_name``: pandas makes doubles of longs with nulls."""
    value = F.col(name).cast("long")
    return F.coalesce(value, F.lit(0).cast("long")).alias(name), value.isNull().alias(f"no_{name}")


def exact_longs(b: pd.DataFrame, name: str = "doc_id") -> pd.Series:
    """The nullable longs that the columns of ``exact`` stand for."""
    return pd.Series(pd.arrays.IntegerArray(b[name].to_numpy(np.int64), b[f"no_{name}"].to_numpy(bool), copy=True), index=b.index)


def string_list(column: pd.Series) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t if isinstance(t, str) else "" for t in column]


def by_group(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows that follow each other with equal keys, in a task sorted by them."""
    rest = None
    for b in batches:
        b = b if rest is None or not len(rest) else pd.concat([rest, b], ignore_index=True)
        if not len(b):
            continue
        cut = np.zeros(len(b) - 1, bool)
        for k in keys:  # as arrays: a shift would make doubles of longs
            v, null = b[k].to_numpy(), b[k].isna().to_numpy()
            cut |= (v[1:] != v[:-1]) & ~(null[1:] & null[:-1])
        cuts = np.flatnonzero(cut) + 1
        lo = 0
        for hi in cuts:
            yield b.iloc[lo:hi]
            lo = hi
        rest = b.iloc[lo:]
    if rest is not None and len(rest):
        yield rest
