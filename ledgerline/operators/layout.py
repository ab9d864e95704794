"""Physical layout: repartitioning, caching scopes, lineage cuts, bucketed tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import fresh_dir, shared_dir

_SIDE = "__ledgerline_side"


def repartition_by(df: DataFrame, cols: Sequence[str], n: int | None = None) -> DataFrame:
    """Hash-partition on ``cols`` (``n`` partitions, or the shuffle default).

    A later aggregate or join whose keys include ``cols`` reuses this
    partitioning and plans no further exchange.
    """
    return df.repartition(n, *cols) if n else df.repartition(*cols)


def coalesce_to(df: DataFrame, n: int) -> DataFrame:
    """Merge partitions without a shuffle (fewer, larger tasks downstream)."""
    return df.coalesce(n)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Cache ``df`` for the actions inside the block and release it after.

    Only worth it when several actions reuse ``df``; a lost executor's
    blocks are recomputed from lineage.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (cuts lineage;
    survives executor loss, unlike a local checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def materialized(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Several sinks fed from the returned frame see the same rows, even when
    ``df`` holds ties broken arbitrarily or a current timestamp.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BUCKET_SHUFFLES = ("rebalance", "repartition", "none")


def write_bucketed(
    df: DataFrame,
    table: str,
    key: str,
    buckets: int = 8,
    sort: bool = True,
    path: str | None = None,
    mode: str = "overwrite",
    shuffle: str = "rebalance",
) -> None:
    """``bucketBy(buckets, key).sortBy(key).saveAsTable(table)``.

    ``shuffle`` decides how rows reach the writer tasks:

    * ``"rebalance"`` (default) -- a ``REBALANCE(buckets, key)`` hint.  It
      hashes exactly like the bucket ids, so a task writes files of one
      bucket; adaptive execution splits an oversized bucket (one hot key)
      over several tasks and files, and merges small ones.
    * ``"repartition"`` -- one task and one file per bucket; a hot key makes
      one task write its whole bucket.
    * ``"none"`` -- every input task writes a file per bucket it sees.

    Readers treat all files of a bucket as one partition, so joins on
    ``key`` plan no exchange in every case.  ``path`` makes the table
    external at a known location, so a fresh session can overwrite a table
    left behind by an earlier run.
    """
    if shuffle not in BUCKET_SHUFFLES:
        raise ValueError(f"shuffle must be one of {BUCKET_SHUFFLES}")
    if shuffle == "rebalance":
        df = df.hint("rebalance", buckets, key)
    elif shuffle == "repartition":
        df = df.repartition(buckets, key)
    writer = df.write.mode(mode).bucketBy(buckets, key)
    if sort:
        writer = writer.sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def dealt(df: DataFrame, flag: Column, name: str = "dealt") -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows where ``flag`` is true, and all others (false or null).

    One pass over ``df`` and one write: rows go to the shared folder under a
    partition column that holds the flag, and each side reads its own folder
    back.  For inputs that are costly to read or parse twice, or that would not
    give the same rows twice.
    """
    if _SIDE in df.columns:
        raise ValueError(f"{_SIDE} is taken")
    path = fresh_dir(df.sparkSession, name)
    flagged = df.withColumn(_SIDE, F.coalesce(flag, F.lit(False)))
    flagged.write.partitionBy(_SIDE).parquet(path)
    both = df.sparkSession.read.schema(flagged.schema).parquet(path)
    return both.where(F.col(_SIDE)).drop(_SIDE), both.where(~F.col(_SIDE)).drop(_SIDE)
