import glob
import json
import os
import re

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from ledgerline.operators.aggregate import count_rows, distinct_rows, row_count, sort_by
from ledgerline.operators.layout import (
    checkpointed,
    coalesce_to,
    materialized,
    persisted,
    repartition_by,
)
from ledgerline.plans import registry
from ledgerline.plans.inspect import physical_plan
from ledgerline.session import fresh_dir, local_path, shared_dir
from ledgerline.sinks import files
from ledgerline.sinks.files import (
    is_empty,
    write_compacted,
    write_csv,
    write_json_documents,
    write_ndjson,
    write_partitioned,
    write_unless_empty,
)
from ledgerline.sinks.jdbc import jdbc_write_options
from ledgerline.sources.files import read_csv, read_json_documents, read_ndjson_tree, read_parquet
from ledgerline.sources.rows import MAX_INLINE_ROWS, from_rows


def parquet_files(path):
    return glob.glob(os.path.join(local_path(path), "**", "*.parquet"), recursive=True)


def test_compacted_file_count_bounded(spark, scratch):
    df = spark.range(0, 2500, 1, 9)
    path = os.path.join(scratch, "c")
    assert write_compacted(df, path, target_bytes=8 * 1000) == 3
    assert len(parquet_files(path)) == 3
    assert spark.read.parquet(path).count() == 2500


@pytest.mark.parametrize("strategy", ["rebalance", "repartition", "none"])
def test_partitioned_write_strategies(spark, scratch, strategy):
    df = spark.range(0, 300, 1, 5).select("id", (F.col("id") % 3).cast("string").alias("p"))
    path = os.path.join(scratch, strategy)
    write_partitioned(df, path, ["p"], strategy=strategy)
    assert sorted(d for d in os.listdir(path) if d.startswith("p=")) == ["p=0", "p=1", "p=2"]
    back = read_parquet(spark, path, schema="id bigint, p string")
    assert back.count() == 300
    if strategy == "repartition":
        assert all(len(glob.glob(os.path.join(path, f"p={i}", "*.parquet"))) == 1 for i in range(3))


def test_dynamic_overwrite_keeps_other_partitions(spark, scratch):
    path = os.path.join(scratch, "dyn")
    first = spark.range(6).select("id", (F.col("id") % 2).cast("string").alias("p"))
    write_partitioned(first, path, ["p"])
    second = spark.range(100, 103).select("id", F.lit("1").alias("p"))
    write_partitioned(second, path, ["p"], dynamic_overwrite=True)
    got = {(r.p, r.id) for r in read_parquet(spark, path, schema="id bigint, p string").collect()}
    assert {x for x in got if x[0] == "0"} == {("0", 0), ("0", 2), ("0", 4)}
    assert {x for x in got if x[0] == "1"} == {("1", 100), ("1", 101), ("1", 102)}


def test_max_records_per_file(spark, scratch):
    path = os.path.join(scratch, "mr")
    write_partitioned(spark.range(0, 100, 1, 1).withColumn("p", F.lit("a")), path, ["p"],
                      strategy="none", max_records_per_file=30)
    assert len(parquet_files(path)) == 4


def test_json_documents_round_trip(spark, scratch):
    df = spark.sql("SELECT id, CAST(id AS DOUBLE) / 3 AS x, "
                   "TIMESTAMP_NTZ'2025-01-01 00:00:00.123456' + make_interval(0,0,0,0,0,0,id) AS ts "
                   "FROM range(0, 50)")
    path = os.path.join(scratch, "docs")
    write_json_documents(df, path, files=3)
    assert len(glob.glob(os.path.join(path, "part-*"))) == 3
    back = read_json_documents(spark, path, schema=df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    # sized by bytes: 50 rows of three 8-byte values at 20 rows per file -> 3 files
    sized = os.path.join(scratch, "docs_sized")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 7)      # would cut a document in two
    try:
        assert write_json_documents(df, sized, target_bytes=20 * 24) == 3
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(glob.glob(os.path.join(sized, "part-*"))) == 3
    assert sorted(read_json_documents(spark, sized, schema=df.schema).collect()) == sorted(df.collect())


def test_json_documents_grow_before_their_number_does(spark, scratch, monkeypatch):
    df = spark.range(0, 1000, 1, 4).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    monkeypatch.setattr(files, "DOCUMENT_BYTES", 20_000)
    for name, options, least, most in (("small", {"target_bytes": 2000}, 50, 70), ("few", {"target_bytes": 2000, "small_files": 3}, 5, 7), ("less", {"target_bytes": 60_000, "small_files": 30}, 2, 2)):
        path = os.path.join(scratch, name)
        n = write_json_documents(df, path, **options)
        assert least <= n <= most and len(glob.glob(os.path.join(path, "part-*"))) == n
        assert sorted(read_json_documents(spark, path, schema=df.schema).collect()) == sorted(df.collect())


def test_split_documents_of_a_large_table_are_several_files(spark, scratch, monkeypatch):
    lines = [(i, f'}}"],[{{ {i} \\', "en", "web", 7) for i in range(200)]
    spark.createDataFrame(lines, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{scratch}/documents.parquet")
    monkeypatch.setattr(registry, "SPLIT_BYTES", 4000)
    folders = []
    monkeypatch.setattr(registry, "fresh_dir", lambda spark, name: folders.append(f"{scratch}/{name}") or folders[-1])
    got = registry.QUERIES["rt_json_split"](spark, scratch)
    assert len(glob.glob(f"{folders[-1]}/part-*")) > 1
    assert sorted(r[:4] for r in got.collect()) == sorted((i, t, '{"}],[{\\\\"en\\\\}"\n]', s) for i, t, _, s, _ in lines)


def test_ndjson_round_trip_keeps_micros(spark, scratch):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ'2025-01-01 00:00:00.654321' AS ts, 'a' AS g FROM range(5)")
    path = os.path.join(scratch, "nd")
    write_ndjson(df, path, ["g"])
    back = read_ndjson_tree(spark, path, schema="id bigint, ts timestamp_ntz", file_glob="*.json")
    assert {r.ts.microsecond for r in back.collect()} == {654321}


def test_csv_round_trip_and_inference(spark, scratch):
    df = spark.sql("SELECT id, CAST(id AS DOUBLE) + 0.5 AS x, 'n' || id AS s FROM range(4)")
    path = os.path.join(scratch, "csv")
    write_csv(df, path)
    assert [t for _, t in read_csv(spark, path).dtypes] == ["string"] * 3
    assert dict(read_csv(spark, path, infer_schema=True).dtypes) == {"id": "int", "x": "double", "s": "string"}


def test_empty_guard(spark, scratch):
    calls = []
    empty = spark.range(0)
    assert is_empty(empty)
    assert not write_unless_empty(empty, calls.append) and calls == []
    assert write_unless_empty(spark.range(1), calls.append) and len(calls) == 1


def test_layout_helpers(spark):
    df = spark.range(0, 100, 1, 4)
    assert repartition_by(df, ["id"], 5).rdd.getNumPartitions() == 5
    assert coalesce_to(df, 2).rdd.getNumPartitions() == 2
    with persisted(df, StorageLevel.MEMORY_AND_DISK) as cached:
        assert cached.count() == 100 and cached.storageLevel.useMemory
    assert not df.storageLevel.useMemory
    cut = checkpointed(df.withColumn("y", F.col("id") * 2))
    assert "LogicalRDD" in physical_plan(cut) or "Scan ExistingRDD" in physical_plan(cut)
    assert materialized(df).count() == 100


def test_shared_dir_uses_checkpoint_setting(spark):
    base = shared_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir().rstrip("/")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_rows_source_and_bound(spark):
    rows = [("a", "first"), ("b", "second")]
    df = from_rows(spark, rows, "code string not null, name string not null")
    assert [tuple(r) for r in df.collect()] == rows
    assert [f.nullable for f in df.schema.fields] == [False, False]
    with pytest.raises(ValueError):
        from_rows(spark, [("a", "b")] * (MAX_INLINE_ROWS + 1), "code string, name string")


def test_aggregate_helpers(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert row_count(df) == 3 and count_rows(df).first().n_rows == 3
    assert sorted(r.k for r in distinct_rows(df, ["k"]).collect()) == ["a", "b"]
    assert [r.k for r in sort_by(df, ["k"]).collect()] == ["a", "b", "b"]


def test_jdbc_options_bound_connections():
    opts = jdbc_write_options(num_partitions=4)
    assert opts["numPartitions"] == "4" and opts["truncate"] == "false"   # overwrite = drop + recreate
    assert jdbc_write_options(truncate=True)["truncate"] == "true"


def test_collect_bounded(spark):
    from ledgerline.operators.aggregate import collect_bounded
    assert len(collect_bounded(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        collect_bounded(spark.range(6), 5)


def test_object_store_helpers():
    from ledgerline.sources.files import abfss_conf, abfss_uri
    assert abfss_uri("raw", "acct", "/year=2025/") == "abfss://raw@acct.dfs.core.windows.net/year=2025/"
    conf = abfss_conf("acct", "k")
    assert conf["spark.hadoop.fs.azure.account.key.acct.dfs.core.windows.net"] == "k"


def test_scale_conf_sizes_partitions():
    from ledgerline.session import scale_conf
    big = scale_conf(100 * (1 << 40))                   # 100 TiB
    assert int(big["spark.sql.shuffle.partitions"]) == 400 * 1024       # 256 MiB each, no cap
    mid = scale_conf(1 << 40)                           # 1 TiB: 4096 x 256 MiB
    assert int(mid["spark.sql.shuffle.partitions"]) == 4096
    assert mid["spark.sql.files.maxPartitionBytes"] == big["spark.sql.files.maxPartitionBytes"]
    assert int(scale_conf(1 << 40, scan_split_bytes=1 << 29)["spark.sql.files.maxPartitionBytes"]) == 1 << 29
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "200"


def test_bucket_count_follows_the_input():
    from ledgerline.session import bucket_count
    assert [bucket_count(n) for n in (0, 1 << 30, 9 << 30, 1 << 40, 100 << 40)] == [8, 8, 16, 1024, 131072]


def test_private_folder_needs_a_local_master():
    from ledgerline.session import require_local
    for master in ("local", "local[4]", "local[*]", "local[4, 2]"):
        require_local(master)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError):
            require_local(master)


def test_paths_must_be_apart(spark, scratch):
    from ledgerline.sinks.files import require_apart
    out = f"{scratch}/out"
    require_apart(spark, {"a": out, "b": f"{scratch}/out2", "c": None})
    for other in (out, f"{out}/", f"file:{out}/x", f"file://{out}", scratch, f"{scratch}/x/../out"):
        with pytest.raises(ValueError):
            require_apart(spark, {"a": out, "b": other})


def test_csv_keeps_blanks_and_line_breaks(spark, scratch):
    rows = [(" a ", "x"), ("b\nc", " y"), ('q"q', "z")]
    path = os.path.join(scratch, "csv")
    write_csv(spark.createDataFrame(rows, "s string, t string"), path)
    back = read_csv(spark, path, options={"multiLine": "true", "emptyValue": ""})
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_ndjson_folders_get_few_files(spark, scratch):
    path = os.path.join(scratch, "tree")
    write_ndjson(spark.range(0, 4000, 1, 20).withColumn("p", F.col("id") % 4), path, ["p"])
    assert len(glob.glob(os.path.join(path, "p=*", "part-*"))) < 20


def test_jdbc_write_narrows_the_inserts_only(spark, monkeypatch):
    from ledgerline.sinks import jdbc
    seen = {}
    from pyspark.sql import DataFrameWriter
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, properties=None: seen.update(df=self._df))
    jdbc.write_jdbc(spark.range(0, 1000, 1, 40), "jdbc:none", "t", {}, num_partitions=3)
    assert "RoundRobinPartitioning(3)" in seen["df"]._jdf.queryExecution().toString()


def test_sort_splits_a_hot_value_over_ranges(spark):
    # one value holds most rows, spread over 8 input splits as exact copies
    hot = spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    cold = spark.range(0, 400, 1, 2).select(F.col("id").cast("string").alias("k"), F.lit(2).alias("v"))
    df = hot.unionByName(cold)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ordered = sort_by(df, ["k"])
        keys = [r.k for r in ordered.collect()]
        assert keys == sorted(keys) and len(keys) == 4400
        parts = ordered.select(F.spark_partition_id().alias("p"), "k").filter(F.col("k") == "hot")
        assert parts.select("p").distinct().count() > 1          # the hot value is cut into ranges
        plain = sort_by(df, ["k"], split_ties=False)
        plain_parts = plain.select(F.spark_partition_id().alias("p"), "k").filter(F.col("k") == "hot")
        assert plain_parts.select("p").distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rebalanced_write_splits_a_hot_folder(spark, scratch):
    # one folder holds 90 % of the rows; with a small target size AQE splits it over tasks
    df = spark.range(0, 200_000, 1, 8).select(
        "id", F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("p"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rebalanced = os.path.join(scratch, "hot_rebalance")
        write_partitioned(df, rebalanced, ["p"])
        by_folder = os.path.join(scratch, "hot_repartition")
        write_partitioned(df, by_folder, ["p"], strategy="repartition")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(os.path.join(rebalanced, "p=hot", "*.parquet"))) > 1
    assert len(glob.glob(os.path.join(by_folder, "p=hot", "*.parquet"))) == 1      # one task, one file
    assert read_parquet(spark, rebalanced, schema="id bigint, p string").count() == 200_000


def test_bucketed_write_splits_a_hot_bucket(spark, scratch):
    from ledgerline.operators.layout import write_bucketed
    from ledgerline.sources.catalog import drop_table, ensure_database
    df = spark.range(0, 200_000, 1, 8).select(
        (F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(-1))).alias("k"), "id")
    ensure_database(spark, "ledgerline_hot", location=os.path.join(scratch, "db"))
    drop_table(spark, "ledgerline_hot.t")
    path = os.path.join(scratch, "hot_bucketed")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_bucketed(df, "ledgerline_hot.t", "k", buckets=4, path=path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    # bucket files are named ..._0000N.c000...; the hot key's bucket has several files
    per_bucket = {}
    for f in parquet_files(path):
        b = re.search(r"_(\d{5})\.c\d+", os.path.basename(f)).group(1)
        per_bucket[b] = per_bucket.get(b, 0) + 1
    assert max(per_bucket.values()) > 1
    assert spark.table("ledgerline_hot.t").count() == 200_000


def test_row_hash_accepts_map_columns(spark):
    from ledgerline.operators.joins import row_salt
    df = spark.sql("SELECT id % 3 AS k, map('a', id) AS m, array(map('b', id)) AS am FROM range(30)")
    ordered = sort_by(df, ["k"])
    assert [r.k for r in ordered.collect()] == sorted(r.k for r in df.collect())
    salts = df.select(row_salt(df, F.col("k") == 0, 4).alias("s")).collect()
    assert all(0 <= r.s < 4 for r in salts)


def test_json_readers_accept_any_iso_spelling(spark, scratch):
    from ledgerline.sources.files import read_ndjson_tree
    folder = os.path.join(scratch, "spellings", "day=01")
    os.makedirs(folder)
    with open(os.path.join(folder, "t.ndjson"), "w") as fh:
        for ts in ["2025-01-01T00:00:00Z", "2025-01-01T00:00:00.654321Z", "2025-01-01 00:00:01",
                   "2025-01-01T02:00:00.5+02:00"]:
            fh.write(json.dumps({"ts": ts}) + "\n")
    got = read_ndjson_tree(spark, os.path.join(scratch, "spellings"), schema="ts timestamp").collect()
    assert len(got) == 4 and all(r.ts is not None for r in got)
    assert any(r.ts.microsecond == 654321 for r in got)
