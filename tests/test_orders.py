import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.aggregate import top_n
from ledgerline.plans.inspect import count_nodes, physical_plan
from ledgerline.plans.orders import (
    ORDER_SCHEMA,
    clean_orders,
    enrich_orders,
    orders_daily,
    read_daily,
    read_orders_json,
    rejected_json_values,
    run_orders,
)
from ledgerline.sources.generate import generate_orders, order_columns

ROWS = [
    # security, price, quantity, timestamp
    (1, 10.0, 5, "2025-03-01 09:00:00"),
    (1, 20.0, 7, "2025-03-01 23:59:59.999999"),   # same security and day, near midnight
    (1, 30.0, 1, "2025-03-02 00:00:00"),          # next day
    (2, None, 4, "2025-03-01 10:00:00"),          # price null
    (2, 5.0, None, "2025-03-01 10:00:00"),        # quantity null
    (3, None, None, "2025-03-01 10:00:00"),       # both null
    (3, 2.5, 2, "2025-03-01 10:00:00"),
]


@pytest.fixture()
def orders(spark):
    schema = "security_id bigint, price double, quantity int, ts string"
    return spark.createDataFrame(ROWS, schema).select(
        "security_id", "price", "quantity", F.col("ts").cast("timestamp").alias("timestamp")
    )


def test_clean_drops_missing_price_or_quantity(orders):
    assert clean_orders(orders).count() == 4


def test_enrich_adds_value_and_day(orders):
    out = {(r.security_id, r.trade_date_str): r.trade_value
           for r in enrich_orders(clean_orders(orders)).collect()}
    assert out[(1, "2025-03-02")] == 30.0
    assert out[(3, "2025-03-01")] == 5.0


def test_daily_sum_and_unweighted_avg(orders):
    rows = {(r.security_id, r.trade_date_str): (r.total_volume, r.avg_price)
            for r in orders_daily(orders).collect()}
    assert rows == {
        (1, "2025-03-01"): (12, 15.0),
        (1, "2025-03-02"): (1, 30.0),
        (3, "2025-03-01"): (2, 2.5),
    }
    assert dict(orders_daily(orders).dtypes)["total_volume"] == "bigint"


def test_iso_string_timestamp_is_accepted(spark):
    df = spark.createDataFrame([(1, 1.0, 1, "2025-03-01T23:30:00Z")],
                               "security_id bigint, price double, quantity int, timestamp string")
    assert orders_daily(df).first().trade_date_str == "2025-03-01"


def test_date_grouping_equals_day_string_grouping(orders):
    # timestamp input groups on the date; text input groups on the per-row string
    as_text = orders.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert sorted(orders_daily(orders).collect()) == sorted(orders_daily(as_text).collect())
    plan = physical_plan(orders_daily(orders))
    assert "hashpartitioning(security_id" in plan and "trade_date#" in plan


def test_preview_uses_total_order(orders):
    daily = orders_daily(orders)
    top = top_n(daily, 2, ["trade_date_str", "security_id"]).collect()
    assert [(r.trade_date_str, r.security_id) for r in top] == [("2025-03-01", 1), ("2025-03-01", 3)]
    assert "TakeOrderedAndProject" in physical_plan(top_n(daily, 2, ["trade_date_str", "security_id"]))


def test_not_null_filter_reaches_scan(spark, scratch):
    path = os.path.join(scratch, "orders.parquet")
    spark.range(10).select(
        F.col("id").alias("security_id"), F.col("id").cast("double").alias("price"),
        F.col("id").cast("int").alias("quantity"), F.current_timestamp().alias("timestamp"),
    ).write.parquet(path)
    plan = physical_plan(orders_daily(spark.read.parquet(path)))
    assert "IsNotNull(price)" in plan and "IsNotNull(quantity)" in plan
    assert "trade_value" not in plan        # computed, never read: pruned


def test_repartition_by_security_is_reused(spark):
    gen = generate_orders(spark, 1000, securities=10, partitions=4)
    res = run_orders(gen, partitions=6, preview_rows=0)
    assert count_nodes(res.daily, "Exchange") == 1


def test_auto_layout_spreads_a_hot_security(spark):
    from ledgerline.plans.orders import layout_orders
    gen = generate_orders(spark, 2000, securities=10, partitions=4)
    # one security takes half of all orders
    skewed = gen.withColumn("security_id", F.when(F.col("quantity") % 2 == 0, F.lit(7)).otherwise(F.col("security_id")))
    cleaned = clean_orders(skewed)
    assert "RoundRobinPartitioning" in physical_plan(layout_orders(cleaned, 6))
    assert "hashpartitioning(security_id" in physical_plan(layout_orders(cleaned, 6, "key"))
    spread = layout_orders(cleaned, 6).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 0.5 * cleaned.count()
    even = run_orders(skewed, partitions=6, preview_rows=0).daily
    by_key = run_orders(skewed, partitions=6, preview_rows=0, layout="key").daily
    a, b = sorted(even.collect()), sorted(by_key.collect())
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert all(r.avg_price == pytest.approx(q.avg_price, rel=1e-12) for r, q in zip(a, b))
    with pytest.raises(ValueError):
        layout_orders(cleaned, 6, "nope")
    # a hot null security is spread too
    null_hot = gen.withColumn("security_id", F.when(F.col("quantity") % 2 == 0, F.lit(None)).otherwise(F.col("security_id")))
    assert "RoundRobinPartitioning" in physical_plan(layout_orders(clean_orders(null_hot), 6))
    assert "hashpartitioning(security_id" in physical_plan(layout_orders(clean_orders(gen), 6))


def test_partitioned_write_and_pruned_read(spark, orders, scratch):
    path = os.path.join(scratch, "daily")
    res = run_orders(orders, preview_rows=3, parquet_path=path)
    assert len(res.preview) == 3
    back = read_daily(spark, path, res.daily.schema, "2025-03-02", "2025-03-02")
    assert dict(back.dtypes)["trade_date_str"] == "string"     # not turned into a date
    assert [r.security_id for r in back.collect()] == [1]
    plan = physical_plan(back)
    assert "PartitionFilters: [isnotnull(trade_date_str" in plan


def test_multiline_json_orders(spark, scratch):
    docs = [
        [{"security_id": 7, "price": 1.5, "quantity": 2, "timestamp": "2025-01-01T10:00:00.000000Z"},
         {"security_id": 7, "price": None, "quantity": 2, "timestamp": "2025-01-01T11:00:00.000000Z"}],
        {"security_id": 8, "price": 2.0, "quantity": 3, "timestamp": "2025-01-02T10:00:00.000000Z"},
    ]
    for i, doc in enumerate(docs):
        with open(os.path.join(scratch, f"o{i}.json"), "w") as fh:
            json.dump(doc, fh, indent=2)
    df = read_orders_json(spark, scratch)
    assert df.count() == 3
    rows = {(r.security_id, r.trade_date_str): r.total_volume for r in orders_daily(df).collect()}
    assert rows == {("7", "2025-01-01"): 2, ("8", "2025-01-02"): 3}


def test_json_values_of_any_spelling_survive(spark, scratch):
    values = [("AAPL", 2.5), ("AAPL", "3.0"), (7, 4.0), (7, "5"), (None, 1)]
    docs = [{"security_id": i, "price": 1.0, "quantity": q, "timestamp": "2025-01-01T10:00:00Z"} for i, q in values]
    with open(os.path.join(scratch, "o.json"), "w") as fh:
        json.dump(docs, fh)
    rows = {r.security_id: r.total_volume for r in orders_daily(read_orders_json(spark, scratch)).collect()}
    assert rows == {"AAPL": 5.5, "7": 9.0, None: 1.0}
    whole = T.StructType.fromDDL("security_id string, price double, quantity bigint, timestamp timestamp")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_orders_json(spark, scratch, whole).collect()
    lenient = read_orders_json(spark, scratch, whole, strict=False)
    assert sorted(r.quantity for r in lenient.collect() if r.quantity is not None) == [1, 3, 4, 5]
    lost = rejected_json_values(spark, scratch, whole).first().asDict()
    assert lost == {"security_id": 0, "price": 0, "quantity": 1, "timestamp": 0}


def test_generator_repeats_no_order(spark):
    moved = spark.range(0, 10).select(*order_columns(F.col("id"))).exceptAll(
        spark.range(1_000_003, 1_000_013).select(*order_columns(F.col("id"))))
    assert moved.count() == 10


def test_generator_is_deterministic_across_partitionings(spark):
    a = generate_orders(spark, 5000, partitions=1)
    b = generate_orders(spark, 5000, partitions=7)
    assert sorted(a.collect()) == sorted(b.collect())
    stats = a.agg(F.min("price"), F.max("price"), F.min("quantity"), F.max("quantity"),
                  F.countDistinct("security_id")).first()
    assert 0 <= stats[0] and stats[1] < 100 and stats[2] >= 1 and stats[3] <= 100 and stats[4] == 1000
    assert dict(a.dtypes) == {"security_id": "int", "price": "double", "quantity": "int",
                              "timestamp": "timestamp_ntz"}
    span = a.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert span[0] >= dt.datetime(2025, 1, 1) and span[1] < dt.datetime(2026, 1, 1)


def test_order_schema_is_explicit():
    assert isinstance(ORDER_SCHEMA, T.StructType) and ORDER_SCHEMA.fieldNames() == [
        "security_id", "price", "quantity", "timestamp"]
