"""Compaction of small files: large ones keep their names, rows stay, readers see one version."""

import glob
import os

from pyspark.sql import functions as F

from ledgerline.sinks.compaction import Manifest, compact_small_files, pack_small_files
from ledgerline.sources.landing import list_files

SCHEMA = "id bigint, text string, day string"


def dataset(spark, root):
    """Three days of six small files each, one large file, and a day of one small file."""
    rows = lambda a, n, day: spark.range(a, a + n).selectExpr("id", "concat('text ', id) AS text", f"'{day}' AS day")
    for k in range(6):
        for d, day in enumerate(("01", "a b+c", "x%y=z")):
            rows(1000 * k + 100 * d, 20, day).repartition(1).write.mode("append").partitionBy("day").parquet(root)
    rows(100_000, 20_000, "01").repartition(1).write.mode("append").partitionBy("day").parquet(root)
    rows(900_000, 5, "09").repartition(1).write.mode("append").partitionBy("day").parquet(root)


def names(root):
    return {os.path.relpath(f, root) for f in glob.glob(f"{root}/day=*/*.parquet")}


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_only_bins_of_several_small_files_are_rewritten(spark, scratch):
    root = f"{scratch}/data"
    dataset(spark, root)
    schema = spark.createDataFrame([], SCHEMA).schema
    expected = rows_of(spark.read.schema(schema).parquet(root))
    before = names(root)
    size = {f: os.path.getsize(f"{root}/{f}") for f in before}
    large = {f for f in before if size[f] > 50_000}
    target = 3 * max(s for f, s in size.items() if f not in large) + 10
    assert len(large) == 1
    replaced = compact_small_files(spark, root, schema, ["day"], small_bytes=50_000, target_bytes=target)
    assert replaced == 18
    manifest = Manifest(spark, root)
    kept = {os.path.relpath(r["path"].split(":", 1)[1], root) for r in manifest.files().collect()}
    assert large <= kept and {f for f in before if "day=09" in f} <= kept
    assert 3 * 2 <= len(kept - before) <= 3 * 3 and not (before - large - {f for f in before if "day=09" in f}) & kept
    assert rows_of(manifest.read(schema)) == expected and manifest.version() == 1
    # old files are still there for readers of the old version, until the vacuum
    assert before < names(root) and manifest.vacuum() == 18 and rows_of(manifest.read(schema)) == expected
    assert names(root) == kept and rows_of(spark.read.schema(schema).parquet(root)) == expected


def test_a_run_that_fails_changes_nothing(spark, scratch, monkeypatch):
    root = f"{scratch}/data"
    dataset(spark, root)
    schema = spark.createDataFrame([], SCHEMA).schema
    expected = rows_of(spark.read.schema(schema).parquet(root))
    manifest = Manifest(spark, root)
    manifest.publish(manifest.files())
    compact = lambda: compact_small_files(spark, root, schema, ["day"], small_bytes=50_000, target_bytes=10**6)
    publish = Manifest.publish
    monkeypatch.setattr(Manifest, "publish", lambda *a: 1 / 0)
    try:
        compact()
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(Manifest, "publish", publish)
    assert rows_of(manifest.read(schema)) == expected and manifest.version() == 1
    assert compact() == 18 and rows_of(manifest.read(schema)) == expected and manifest.version() == 2
    assert compact() == 0  # nothing left to do
    manifest.vacuum()
    assert rows_of(spark.read.schema(schema).parquet(root)) == expected


def test_packing(spark):
    files = spark.createDataFrame([(f"f:/a/{i}", s) for i, s in enumerate([10, 10, 30, 30, 30, 500])] + [("f:/b/1", 10), ("f:/c/1", 99), ("f:/c/2", 99)], "path string, length bigint")
    got = {(r["path"], r["bin"]) for r in pack_small_files(files, 100, 50).collect()}
    assert got == {("f:/a/0", 0), ("f:/a/1", 0), ("f:/a/2", 0), ("f:/a/3", 1), ("f:/a/4", 1)}


def test_dataset_without_folders(spark, scratch):
    frame = spark.range(100).select("id", F.lit("x").alias("text"))
    frame.repartition(10).write.parquet(scratch + "/flat")
    assert compact_small_files(spark, scratch + "/flat", frame.schema, target_bytes=10**6) == list_files(spark, scratch + "/flat", "*.parquet").count() - 1 == 10
    assert rows_of(Manifest(spark, scratch + "/flat").read(frame.schema)) == rows_of(frame)
