"""Compaction of the small files of a dataset; large files are left as they are.

Small files are packed into bins of about a target size, folder by folder.
Only the files of bins that hold several are read and written again, a task
and a new file for each bin.  What belongs to the dataset is told by a manifest,
a list of files with a version: new files are not seen before the manifest
that names them is in place, and the old ones stay until they are vacuumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.aggregate import with_row_number
from ledgerline.operators.layout import materialized
from ledgerline.sources.landing import list_files, path_exists

MIB = 1024 * 1024
_BIN = "__ledgerline_bin"
_SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*:/+"


def pack_small_files(files: DataFrame, small_bytes: int, target_bytes: int) -> DataFrame:
    """``path, length, folder, bin`` of the files that are worth rewriting.

    Files below ``small_bytes`` are laid out by folder in order of size; each
    stretch of ``target_bytes`` is a bin (a file belongs to the stretch that
    its first byte falls into, so a bin exceeds the target by less than one
    small file).  Bins of a single file are left out.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    small = files.where(F.col("length") < small_bytes).withColumn("folder", folder)
    ahead = Window.partitionBy("folder").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("length").over(ahead), F.lit(0))
    binned = small.withColumn("bin", F.floor(start / F.lit(target_bytes)).cast("bigint"))
    several = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin")) > 1
    return binned.withColumn("several", several).where("several").select("path", "length", "folder", "bin")


class Manifest:
    """Versions of the list of files of the Parquet dataset at ``root``, below ``root/_manifest``.

    Readers take the greatest version.  A dataset without one consists of all
    files found.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> DataFrame | None:
        place = f"{self.root}/_manifest"
        if not path_exists(self.spark, place):
            return None
        return self.spark.read.schema("path string, length bigint, version bigint").parquet(place)

    def version(self) -> int:
        """The current version, 0 without a manifest."""
        versions = self._versions()
        return (versions.agg(F.max("version")).first()[0] or 0) if versions is not None else 0

    def files(self) -> DataFrame:
        """``path, length`` of the dataset's files."""
        version = self.version()
        if version:
            return self._versions().where(F.col("version") == version).select("path", "length")
        return list_files(self.spark, self.root, "*.parquet").select("path", "length")

    def publish(self, files: DataFrame) -> int:
        """Write the next version; it appears as one file."""
        version = self.version() + 1
        files.select("path", "length").repartition(1).write.parquet(f"{self.root}/_manifest/version={version}")
        return version

    def read(self, schema: T.StructType) -> DataFrame:
        """The dataset's rows; ``schema`` keeps partition values as they were written."""
        paths = [r["path"] for r in self.files().select("path").toLocalIterator()]  # as many as a scan lists anyway
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)

    def vacuum(self) -> int:
        """Delete Parquet files that the current version does not name; returns how many.  Call it
        when no reader of an earlier version is left."""
        found = list_files(self.spark, self.root, "*.parquet").where(~F.col("path").contains("/_manifest/"))
        stale = materialized(found.join(self.files(), "path", "left_anti").select("path"), "vacuum")
        hadoop, deleted = self.spark.sparkContext._jvm.org.apache.hadoop.fs, 0
        for row in stale.toLocalIterator():
            target = hadoop.Path(row["path"])
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, False)
            deleted += 1
        return deleted


def compact_small_files(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    partition_cols: Sequence[str] = (),
    small_bytes: int = 64 * MIB,
    target_bytes: int = 256 * MIB,
) -> int:
    """Rewrite the small files of the Parquet dataset at ``root``; returns how many were replaced.

    The bins' files are read in one scan and dealt by bin, and each bin is
    written as one file into its own folder (``partition_cols`` name the
    folders' columns).  Then a manifest names the new files and those not
    touched.  A run that fails before leaves the dataset as it was.
    """
    manifest = Manifest(spark, root)
    before = materialized(manifest.files(), "files")
    packed = materialized(pack_small_files(before, small_bytes, target_bytes), "bins")
    replaced = packed.count()
    if not replaced:
        return 0
    paths = [r["path"] for r in packed.select("path").toLocalIterator()]
    known = materialized(list_files(spark, root, "*.parquet").select("path"), "known")
    rows = spark.read.schema(schema).option("basePath", manifest.root).parquet(*paths).withColumn("__path", _file_name())
    numbered = with_row_number(packed.select("folder", "bin").distinct(), ["folder", "bin"], _BIN)
    bins = packed.join(numbered, ["folder", "bin"]).select(F.regexp_replace("path", _SCHEME, "/").alias("__path"), F.col(_BIN) - 1)
    dealt = rows.join(bins.toDF("__path", _BIN), "__path").drop("__path")
    # a task for each bin: its rows have one folder, hence one file
    spread = dealt.repartitionById(numbered.count(), F.col(_BIN).cast("int")).drop(_BIN)
    writer = spread.write.mode("append")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(manifest.root)
    added = list_files(spark, root, "*.parquet").select("path", "length").join(known, "path", "left_anti")
    added = added.where(~F.col("path").contains("/_manifest/"))
    manifest.publish(before.join(packed.select("path"), "path", "left_anti").unionByName(added))
    return replaced


def _file_name():
    """Path of the file that a row comes from, without its scheme, decoded as the listing spells it."""
    return F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), _SCHEME, "/")
