import pytest
from pyspark.sql import functions as F

from ledgerline.operators.dedup import latest_per_key, latest_per_key_agg
from ledgerline.operators.profile import key_skew, partition_profile


def test_partition_profile_counts(spark):
    df = spark.range(0, 1000, 1, 6).withColumn("k", F.col("id") % 7)
    prof = partition_profile(df, "k", exact_distinct=True).collect()
    assert len(prof) == 6
    assert sum(r.rows for r in prof) == 1000
    assert all(r.distinct_keys == 7 and r.min_key == 0 and r.max_key == 6 for r in prof)
    assert partition_profile(df).columns == ["partition", "rows"]


def test_key_skew_shares(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "k string")
    rows = {r.k: (r.n_rows, r.share) for r in key_skew(df, "k").collect()}
    assert rows == {"a": (6, 0.6), "b": (3, 0.3), "c": (1, 0.1)}


def test_dedup_forms_agree(spark):
    rows = [(k, ts, i) for k in range(20) for ts in range(5) for i in range(2)]
    df = spark.createDataFrame(rows, "k int, ts int, i int")
    a = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts"], ["i"]).collect())
    b = sorted(tuple(r) for r in latest_per_key_agg(df, ["k"], ["ts"], ["i"]).collect())
    assert a == b and len(a) == 20 and all(r[1] == 4 and r[2] == 1 for r in a)


def test_dedup_result_independent_of_partitioning(spark):
    rows = [(k % 13, k, k * 3 % 17) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, ts int, v int")
    one = sorted(latest_per_key(df.repartition(1), ["k"], ["ts"]).collect())
    many = sorted(latest_per_key(df.repartition(9), ["k"], ["ts"]).collect())
    assert one == many


def test_key_skew_reads_input_once(spark):
    from ledgerline.operators.profile import key_skew
    from ledgerline.plans.inspect import physical_plan
    df = spark.range(0, 1000, 1, 4).selectExpr("id % 7 AS k")
    report = key_skew(df, "k")
    report.collect()
    # the total's subquery reuses the per-key counts' shuffle instead of a second pass
    assert "ReusedExchange" in physical_plan(report)


def test_hot_keys_without_shuffling_keys(spark):
    """The same keys as the exact count, found by summaries; a task shuffles a count per candidate."""
    import random

    from ledgerline.operators.profile import hot_keys, key_skew

    rng = random.Random(3)
    rows = [("hot",)] * 3000 + [("warm",)] * 500 + [("edge",)] * 100 + [(None,)] * 1400 + [(f"u{i}",) for i in range(5000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string").repartition(6)
    for share in (0.3, 0.1, 0.05, 0.01, 0.005, 0.00015):
        exact = key_skew(df, "k", digits=None).where(f"share >= {share}")
        assert {r["k"] for r in exact.collect()} == set(hot_keys(df, "k", share, nulls=True))
        assert set(hot_keys(df, "k", share)) == {r["k"] for r in exact.where("k is not null").collect()}
    assert hot_keys(df.where("k is null"), "k", 0.5) == [] and hot_keys(df.where("k is null"), "k", 0.5, nulls=True) == [None]
    assert hot_keys(df.limit(0), "k", 0.1) == []


def test_row_number_without_one_task_window(spark):
    from ledgerline.operators.aggregate import with_row_number

    rows = [(i % 7, i, f"n{i}") for i in range(500)] + [(None, 900, "x")]
    df = spark.createDataFrame(rows, "a int, b int, row_text string").repartition(5)
    got = with_row_number(df, [F.col("a").desc_nulls_last(), "b"], "rank")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1 and plan.count("SinglePartition") == 1  # over the counts per range only
    expected = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 502))
    assert with_row_number(df.limit(0), ["a"]).count() == 0
    with pytest.raises(ValueError):
        with_row_number(df, ["a"], "b")
