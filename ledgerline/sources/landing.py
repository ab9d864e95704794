"""Incremental reading of a landing tree: a ledger of the files already processed.

The tree is listed, not read (path, length and time of each file); files that
the ledger holds are taken out by an anti-join.  What remains is processed in
batches:

1. the batch's files are written to the ledger as *planned*;
2. the caller processes them and writes its output under the batch's name;
3. the batch is written to the ledger as *done*.

A run that ended between 1 and 3 left a planned batch.  The next run repeats
that very batch under the same name first, so its output is replaced, not
doubled, and no file is lost.  A file that was changed (another length or
time) is new.  One run at a time may work on a ledger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.aggregate import collect_bounded

FILE_SCHEMA = "path string, length bigint, modified bigint"
_FILE = ["path", "length", "modified"]


def list_files(spark: SparkSession, root: str, file_glob: str = "*") -> DataFrame:
    """``path, length, modified`` (microseconds) of the files at any depth below ``root``, contents unread."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", file_glob)
        .load(root)
    )
    return files.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


class FileLedger:
    """Planned and done batches of files, as Parquet folders ``planned/batch=`` and ``done/batch=`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, state: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{state}"):
            return self.spark.createDataFrame([], f"{FILE_SCHEMA}, batch string")
        return self.spark.read.schema(f"{FILE_SCHEMA}, batch string").parquet(f"{self.path}/{state}")

    def done(self) -> DataFrame:
        """Files of all batches that were committed, with their batch."""
        return self._read("done")

    def open_files(self) -> DataFrame:
        """Files of batches that were planned and not committed."""
        return self._read("planned").join(self.done().select("batch").distinct(), "batch", "left_anti")

    def new_files(self, listing: DataFrame) -> DataFrame:
        """Files of ``listing`` in no batch yet."""
        known = self._read("planned").select(*_FILE)  # every done batch was planned
        return listing.join(known, _FILE, "left_anti").select(*_FILE)

    def _write(self, state: str, batch: str, files: list[tuple]) -> None:
        rows = self.spark.createDataFrame(files, FILE_SCHEMA)
        # one file, so that the batch appears whole or not at all
        rows.repartition(1).write.mode("overwrite").parquet(f"{self.path}/{state}/batch={batch}")

    def plan(self, files: list[tuple]) -> str:
        """Record a batch and return its name: a digest of its files."""
        batch = hashlib.sha256(repr(sorted(files)).encode()).hexdigest()[:32]
        self._write("planned", batch, files)
        return batch

    def commit(self, batch: str, files: list[tuple]) -> None:
        self._write("done", batch, files)


def _batches(ledger: FileLedger, listing: DataFrame, max_files: int) -> Iterator[tuple[str, list[tuple]]]:
    """Open batches, then new ones, oldest files first, of at most ``max_files`` files each."""
    for row in ledger.open_files().select("batch").distinct().toLocalIterator():  # one, as runs stop at a failure
        files = ledger.open_files().where(F.col("batch") == row["batch"]).select(*_FILE)
        yield row["batch"], [tuple(r) for r in files.toLocalIterator()]  # bounded by the run that planned it
    while True:
        fresh = ledger.new_files(listing).orderBy("modified", "path").limit(max_files)
        files = [tuple(r) for r in collect_bounded(fresh, max_files)]
        if not files:
            return
        yield ledger.plan(files), files


def process_new_files(
    spark: SparkSession,
    root: str,
    ledger_path: str,
    process: Callable[[list[str], str], object],
    file_glob: str = "*",
    max_files: int = 10_000,
) -> list[str]:
    """Call ``process(paths, batch)`` for the files below ``root`` that no earlier run
    committed, at most ``max_files`` at a time; returns the batches done.

    ``process`` must write its output under ``batch`` in a way that replaces
    what an earlier try left.  The driver holds the names of one batch.
    """
    ledger, done = FileLedger(spark, ledger_path), []
    if not path_exists(spark, root):
        return done
    for batch, files in _batches(ledger, list_files(spark, root, file_glob), max_files):
        process([f[0] for f in files], batch)
        ledger.commit(batch, files)
        done.append(batch)
    return done


def read_batches(spark: SparkSession, path: str, ledger_path: str, schema) -> DataFrame:
    """Rows under ``path/batch=<name>`` whose batch the ledger holds as done; an open batch is not seen."""
    rows = spark.read.schema(schema.add("batch", "string")).parquet(path)
    committed = FileLedger(spark, ledger_path).done().select("batch").distinct()
    return rows.join(committed, "batch", "left_semi").drop("batch")
