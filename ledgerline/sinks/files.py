"""File sinks: partitioned and compacted Parquet, NDJSON, CSV, JSON documents."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import row_bytes
from ledgerline.sources.files import TIMESTAMP_MICROS, TIMESTAMP_NTZ_MICROS

#: Bytes of rows in a file of JSON documents, about.
DOCUMENT_BYTES = 64 * 1024 * 1024
SHUFFLE_STRATEGIES = ("rebalance", "repartition", "none")

_JSON_TIME_OPTIONS = {
    "timestampFormat": TIMESTAMP_MICROS,
    "timestampNTZFormat": TIMESTAMP_NTZ_MICROS,
}


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    mode: str = "overwrite",
    compression: str = "snappy",
    strategy: str = "rebalance",
    max_records_per_file: int | None = None,
    dynamic_overwrite: bool = False,
) -> None:
    """Hive-layout Parquet (``col=value/`` directories).

    ``strategy``:

    * ``"rebalance"`` (default) -- a ``REBALANCE`` hint on the partition
      columns: rows of one directory meet in few tasks (few files), and
      adaptive execution splits a hot directory over several tasks and
      merges tiny ones.  One day or pair holding a third of the rows is
      written by many tasks, not one.
    * ``"repartition"`` -- the reference recipe, one task (one file) per
      directory; a hot directory becomes one huge task.
    * ``"none"`` -- write as partitioned (many small files).

    ``max_records_per_file`` caps file size inside a task.
    ``dynamic_overwrite`` replaces only the directories present in ``df``.
    """
    cols = list(partition_cols)
    if strategy not in SHUFFLE_STRATEGIES:
        raise ValueError(f"strategy must be one of {SHUFFLE_STRATEGIES}")
    if strategy == "rebalance":
        df = df.hint("rebalance", *cols)
    elif strategy == "repartition":
        df = df.repartition(*cols)
    writer = df.write.mode(mode).option("compression", compression).partitionBy(*cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as its file system spells it, without a slash at the end."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString().rstrip("/")


def require_apart(spark: SparkSession, paths: dict[str, str | None]) -> None:
    """Raise unless the given paths (by name; ``None`` is skipped) are neither
    equal nor inside one another, whatever their spelling."""
    whole = [(name, qualified(spark, p)) for name, p in paths.items() if p]
    for i, (a, x) in enumerate(whole):
        for b, y in whole[:i]:
            if x == y or x.startswith(y + "/") or y.startswith(x + "/"):
                raise ValueError(f"{a} and {b} must be apart: {x}, {y}")


def text_bytes(df: DataFrame) -> int:
    """Bytes of all rows as measured by :func:`row_bytes` (one pass, one number per task)."""
    return df.agg(F.sum(row_bytes(df.schema)).alias("n")).first()["n"] or 0


def write_compacted(
    df: DataFrame,
    path: str,
    target_bytes: int = 256 * 1024 * 1024,
    mode: str = "overwrite",
    compression: str = "snappy",
) -> int:
    """Few, evenly filled files of about ``target_bytes`` each (measured before
    encoding and compression, so files come out smaller).  Returns their number.

    Replaces the reference's ``coalesce(1)`` debug export, which funnels the
    whole dataset through one task.  Write it to its own path, never inside
    a partitioned dataset's directory.
    """
    files = max(1, math.ceil(text_bytes(df) / target_bytes))
    df.repartition(files).write.mode(mode).option("compression", compression).parquet(path)
    return files


def write_ndjson(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """One JSON object per line; timestamps keep microseconds.

    With ``partition_cols`` the rows of a folder meet in few tasks first (a
    rebalance hint), so each folder gets few files, and a hot one is split.
    """
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode(mode).options(**_JSON_TIME_OPTIONS)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.json(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """CSV that keeps blanks around values.  A value with a line break is quoted;
    read such files with ``options={"multiLine": "true"}`` (one task per file)."""
    options = {"header": str(header).lower(), "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode(mode).options(**options).csv(path)


def _bracket_step():
    """The per-partition step, built as a local function so Spark ships its
    code with the task: executors need no installed copy of this package."""

    def bracket_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Turn one partition's JSON lines into one JSON array, streaming batch by batch."""
        started = False
        for batch in batches:
            if not batch.num_rows:
                continue
            lines = batch.column(0)
            values = pc.binary_join_element_wise(pa.scalar(",", lines.type), lines, pa.scalar("", lines.type))
            if not started:
                first = pa.array(["[" + lines[0].as_py()], lines.type)
                values = pa.concat_arrays([first, values.slice(1)])
                started = True
            yield pa.RecordBatch.from_arrays([values], names=["value"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    return bracket_documents


def write_json_documents(
    df: DataFrame,
    path: str,
    files: int | None = None,
    mode: str = "overwrite",
    target_bytes: int = DOCUMENT_BYTES,
    small_files: int | None = None,
) -> int:
    """Multi-line JSON: files that each hold one JSON array of row objects.

    ``files`` fixes the file count; by default files hold about
    ``target_bytes``, so every file (and the one task a reader spends on it)
    stays bounded.  With ``small_files`` no more than that many files are
    smaller than :data:`DOCUMENT_BYTES`: a larger input fills files of that
    size instead of a file for every few rows.  A session's cap on records per file does not apply, as it
    would cut a document in two.  Rows are rendered by ``to_json`` in the JVM; a
    streaming Arrow step only adds the brackets and commas, holding one
    batch at a time.  Returns the number of files aimed at.
    """
    if files is None:
        size = text_bytes(df)
        files = max(1, math.ceil(size / target_bytes))
        if small_files is not None:
            files = min(files, max(small_files, math.ceil(size / DOCUMENT_BYTES)))
    lines = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), _JSON_TIME_OPTIONS).alias("value"))
    documents = lines.repartition(files).mapInArrow(_bracket_step(), "value string")
    documents.write.mode(mode).option("maxRecordsPerFile", 0).text(path)
    return files


def is_empty(df: DataFrame) -> bool:
    """True when ``df`` has no row (reads at most one row)."""
    return df.isEmpty()


def write_unless_empty(df: DataFrame, write: Callable[[DataFrame], object]) -> bool:
    """Run ``write(df)`` only when ``df`` has rows; returns whether it wrote."""
    if is_empty(df):
        return False
    write(df)
    return True
