"""Lines of files with the byte at which each begins, and reading on from a saved position.

Spark cuts files into blocks and gives every line to the block in which it begins. Lines of a block are in
order, so a line's place is the sum of what comes before it in its block (summed as batches pass, without
a shuffle) and of the blocks before that (a row a block). Any file system that Spark reads will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RAW = ("_metadata.file_path as file", "_metadata.file_block_start as block", "_metadata.file_size as file_size", "value as line")


def raw_lines(spark: SparkSession, path: str, stream: bool = False, max_files: int = 100) -> DataFrame:
    """file, block, file_size, line of text files. Only the line feed ends a line."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if stream else spark.read
    return reader.option("lineSep", "\n").text(path).selectExpr(*RAW)


def with_positions(raw: DataFrame) -> DataFrame:
    """file, byte, next, line: where each line begins, and what follows its end. A carriage return at the end is no part of a line.

    raw: what ``raw_lines`` gives, a whole table or a micro-batch. Blank lines have a position, too.
    """
    sizes = raw.groupBy("file", "block").agg(F.sum(F.octet_length("line") + 1).alias("_size"))  # a row a block
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", "block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            file, block = b.column("file").dictionary_encode(), b.column("block").to_numpy()
            size = pc.binary_length(pc.cast(b.column("line"), pa.binary())).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            code = file.indices.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
            at = np.empty(len(size), np.int64)
            for lo, hi in zip([0, *cuts], [*cuts, len(size)], strict=True):
                now = (file.dictionary[code[lo]].as_py(), int(block[lo]))
                total, last = (total if now == last else 0), now
                ends = total + np.cumsum(size[lo:hi])
                at[lo:hi], total = ends - size[lo:hi], int(ends[-1])
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), b.column("file_size"), b.column("line"), pa.array(at), pa.array(size)], ["file", "block", "file_size", "line", "_at", "_length"])

    placed = raw.mapInArrow(run, "file string, block long, file_size long, line string, _at long, _length long").join(starts, ["file", "block"])
    byte = F.col("_start") + F.col("_at")
    return placed.select("file", byte.alias("byte"), F.least(byte + F.col("_length"), F.col("file_size")).alias("next"), F.regexp_replace("line", "\r$", "").alias("line"))


def after(lines: DataFrame, positions: DataFrame | None) -> DataFrame:
    """Lines that begin at or behind each file's saved position (file, next); all of files without one."""
    if positions is None:
        return lines
    seen = positions.groupBy("file").agg(F.max("next").alias("_seen"))
    return lines.join(seen, "file", "left").filter(F.col("_seen").isNull() | (F.col("byte") >= F.col("_seen"))).drop("_seen")


def read_up_to(lines: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """file, next: the position to save when these lines have been delivered; files without new lines keep theirs."""
    new = lines.select("file", "next")
    return (new if positions is None else new.unionByName(positions.select("file", "next"))).groupBy("file").agg(F.max("next").alias("next"))
