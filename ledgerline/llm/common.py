"""Shared helpers of the training-data operators.

Operators here take DataFrames and column names.  They never rely on row ids
being unique: rows travel with their own values, and what has to be looked up
per row is keyed by content (a hash of the text, the set or the entity).
"""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import fresh_dir

#: ASCII white space as a character class body: space, tab, LF, VT, FF, CR.
SPACE_CLASS = r"\x20\x09-\x0D"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor; columns keep
    their order and types.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "llm", label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete one folder written by an operator, through Spark's file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables of one iterative operator: each is written once and may be released."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base, self.n = spark, fresh_dir(spark, "llm", label), 0

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = f"{self.base}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def release(self, path: str) -> None:
        release(self.spark, path)


def bit_filter(wanted: DataFrame, column: str) -> tuple[Broadcast, int]:
    """A broadcast array of bits that tells which 64-bit values may be wanted, and the bits of a value that it looks at.

    Between 2^16 and 2^27 bits, at least 16 for each value as long as that
    lasts: 16 MB at most.  Beyond, it lets more unwanted values through,
    which joins have to sort out anyway.
    """
    bits = min(27, max(16, 4 + int(wanted.count()).bit_length()))
    slot = F.pmod(column, F.lit(1 << bits))
    words = wanted.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
    mask = np.zeros((1 << bits) // 64, np.uint64)
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("bits")).toArrow()  # at most 2^21 words of 16 bytes
    mask[found.column("w").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return wanted.sparkSession.sparkContext.broadcast(mask), bits


def let_through(part: pa.RecordBatch, column: int, mask: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows whose value a bit filter lets through."""
    slot = part.column(column).to_numpy(zero_copy_only=False) & ((1 << bits) - 1)
    return part.filter(pa.array(((mask[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)))


def drop_unused(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of frames that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` for columns of an operator's own, lengthened where ``df`` has such a column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is bound to the value, so the optimizer cannot inline
    an expensive array into the lambdas that read it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words (runs of anything but ASCII white space) of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), "")


def arrow_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one thread per task: Spark already runs a task on every core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """A record batch in pieces of at most ``rows`` rows."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
