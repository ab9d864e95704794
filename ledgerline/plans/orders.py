"""Orders: daily traded volume and average price per security.

clean (price and quantity present) -> enrich (trade value, day string) ->
sum/avg per (security, day) -> ordered preview / partitioned Parquet / JDBC.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import day_string, parse_timestamp, trade_value
from ledgerline.operators.aggregate import collect_bounded, daily_volume_price, top_n
from ledgerline.operators.layout import persisted, repartition_by
from ledgerline.operators.profile import hot_keys, partition_profile
from ledgerline.operators.quality import require_not_null
from ledgerline.sinks.files import write_partitioned
from ledgerline.sinks.jdbc import write_jdbc
from ledgerline.sources.files import read_parquet
from ledgerline.sources.generate import generate_orders
from ledgerline.sources.json_arrays import read_json_array

#: Default types of orders read from JSON: any id is kept as text, any number as a double.
ORDER_SCHEMA = T.StructType([
    T.StructField("security_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
])


def clean_orders(orders: DataFrame) -> DataFrame:
    """Drop orders without a price or a quantity (native predicates: pushed to the scan)."""
    return require_not_null(orders, ["price", "quantity"])


def enrich_orders(orders: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add ``trade_value = price * quantity`` and ``trade_date_str = yyyy-MM-dd``."""
    return orders.withColumns({
        "trade_value": trade_value("price", "quantity"),
        "trade_date_str": day_string(ts),
    })


_TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)


def orders_daily(orders: DataFrame, round_digits: int | None = None, ts: str = "timestamp") -> DataFrame:
    """``security_id, trade_date_str, total_volume, avg_price``.

    For a timestamp column the groups are formed on the calendar date (a
    4-byte value) and ``trade_date_str`` is formatted once per group after
    the final aggregate.  The date -> ``yyyy-MM-dd`` mapping is one-to-one, so
    the groups are the reference's, while hashing, the shuffled rows and the
    string formatting shrink from per order to per group.  Text timestamps
    go through the per-row day string, as in the reference.
    """
    cleaned = clean_orders(orders)
    if not isinstance(cleaned.schema[ts].dataType, _TEMPORAL):
        return daily_volume_price(enrich_orders(cleaned, ts), round_digits=round_digits)
    by_date = daily_volume_price(
        cleaned.withColumn("trade_date", F.to_date(ts)), day="trade_date", round_digits=round_digits
    )
    return by_date.select(
        "security_id", day_string("trade_date").alias("trade_date_str"), "total_volume", "avg_price"
    )


def daily_preview(daily: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows by day, then security (a total order, so the preview is defined)."""
    return top_n(daily, n, ["trade_date_str", "security_id"])


def read_daily(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    day_from: str | None = None,
    day_to: str | None = None,
) -> DataFrame:
    """Read a day-partitioned result back; the day range prunes directories.

    ``schema`` keeps ``trade_date_str`` a string (discovery would make it a date).
    """
    df = read_parquet(spark, path, schema=schema)
    if day_from is not None:
        df = df.filter(df["trade_date_str"] >= day_from)
    if day_to is not None:
        df = df.filter(df["trade_date_str"] <= day_to)
    return df


def read_orders_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ORDER_SCHEMA,
    strict: bool = True,
) -> DataFrame:
    """Orders from multi-line JSON documents of any size, read in splits.

    Every field is parsed as text, so no spelling turns into null in the
    parser, and then cast to ``schema``: ``2.5``, ``3.0``, ``"7"`` and text ids
    all survive.  Timestamps follow Spark's ISO rules (``T`` or space,
    optional fraction, ``Z`` or an offset).  ``strict`` fails on text that a
    type cannot hold (ANSI); otherwise it becomes null, and
    :func:`rejected_json_values` counts what did.
    """
    raw = read_json_array(spark, path, _as_text(schema))
    return raw.select(*[_typed(f, strict).alias(f.name) for f in schema.fields])


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), f.nullable) for f in schema.fields])


def _typed(field: T.StructField, strict: bool) -> Column:
    """Text field ``field.name`` in its type; a whole number may be spelt ``3.0``."""
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return parse_timestamp(field.name, strict).cast(field.dataType)
    if isinstance(field.dataType, T.IntegralType):
        text = F.regexp_replace(text, r"^([+-]?\d+)\.0+$", "$1")
    return text.cast(field.dataType) if strict else text.try_cast(field.dataType)


def rejected_json_values(spark: SparkSession, path: str, schema: T.StructType = ORDER_SCHEMA) -> DataFrame:
    """One row: for each field, how many values the permissive reading turns into null."""
    raw = read_json_array(spark, path, _as_text(schema))
    lost = {f.name: F.col(f"`{f.name}`").isNotNull() & _typed(f, strict=False).isNull() for f in schema.fields}
    return raw.agg(*[F.count_if(cond).alias(name) for name, cond in lost.items()])


@dataclass
class OrdersResult:
    daily: DataFrame
    preview: list
    parquet_path: str | None


def _daily_outputs(
    cleaned: DataFrame,
    preview_rows: int,
    parquet_path: str | None,
    jdbc: dict | None,
) -> OrdersResult:
    daily = orders_daily(cleaned)
    outputs = bool(preview_rows) + bool(parquet_path) + bool(jdbc)
    # Several outputs read the aggregate, not the orders: keep it between them
    # (it is far smaller than the input) instead of re-reading and re-shuffling.
    scope = persisted(daily) if outputs > 1 else nullcontext(daily)
    with scope:
        preview = daily_preview(daily, preview_rows).collect() if preview_rows else []
        if parquet_path:
            write_partitioned(daily, parquet_path, ["trade_date_str"])
        if jdbc:
            write_jdbc(daily, jdbc["url"], jdbc["table"], jdbc["properties"])
    return OrdersResult(daily, preview, parquet_path)


LAYOUTS = ("auto", "key", "even")


def layout_orders(cleaned: DataFrame, partitions: int, layout: str = "auto") -> DataFrame:
    """Spread cleaned orders over ``partitions`` partitions.

    * ``"key"`` -- hash by ``security_id`` (the reference): the daily
      aggregate reuses the partitioning and plans no further exchange, but
      all orders of one security share one partition and one task;
    * ``"even"`` -- evenly sized partitions; the aggregate combines each
      partition map-side, then shuffles only the partial sums;
    * ``"auto"`` -- ``"key"`` unless a security (or the null key) holds at
      least ``1 / partitions`` of all orders (more than an average
      partition), found by :func:`hot_keys` over the key column.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "auto":
        # the null group counts too: hashing sends all null keys to one partition
        layout = "even" if hot_keys(cleaned, "security_id", 1 / partitions, nulls=True) else "key"
    if layout == "key":
        return repartition_by(cleaned, ["security_id"], partitions)
    return cleaned.repartition(partitions)


def run_orders(
    orders: DataFrame,
    partitions: int | None = None,
    preview_rows: int = 20,
    parquet_path: str | None = None,
    jdbc: dict | None = None,
    layout: str = "auto",
) -> OrdersResult:
    """The whole orders job.

    ``partitions`` lays the cleaned orders out first (:func:`layout_orders`):
    by ``security_id`` the aggregate on (security_id, day) reuses that
    partitioning and plans no second exchange.  The preview is a top-n,
    never a full sort.  ``parquet_path`` writes the result partitioned by
    day; ``jdbc`` (``url``, ``table``, ``properties``) writes it to a
    database table.
    """
    cleaned = clean_orders(orders)
    if partitions:
        cleaned = layout_orders(cleaned, partitions, layout)
    return _daily_outputs(cleaned, preview_rows, parquet_path, jdbc)


def run_orders_json(
    spark: SparkSession,
    path: str,
    preview_rows: int = 20,
    parquet_path: str | None = None,
    jdbc: dict | None = None,
    schema: T.StructType | str = ORDER_SCHEMA,
    strict: bool = True,
    partitions: int | None = None,
    layout: str = "auto",
) -> OrdersResult:
    """Orders from multi-line JSON documents (explicit schema, no inference pass).

    ``schema`` (a type or a DDL string) names the fields and their types;
    ``partitions`` and ``layout`` lay the orders out as in :func:`run_orders`.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return run_orders(read_orders_json(spark, path, schema, strict), partitions, preview_rows, parquet_path, jdbc, layout)


@dataclass
class GeneratedOrdersResult:
    rows: int
    partitions: list
    preview: list
    parquet_path: str | None


def run_generated_orders(
    spark: SparkSession,
    n: int = 2_000_000,
    partitions: int = 50,
    level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
    preview_rows: int = 20,
    parquet_path: str | None = None,
    jdbc: dict | None = None,
    start: str = "2025-01-01 00:00:00",
    layout: str = "auto",
    securities: int = 1000,
) -> GeneratedOrdersResult:
    """Synthetic orders -> clean -> lay out (by security unless one is hot) -> cache ->
    partition profile -> daily aggregate, preview and sinks.

    The cache is filled once (``count``) and serves the profile, the preview
    and every sink; it is released at the end.  The profile has one row per
    partition, so bringing it to the driver is bounded by ``partitions``.
    """
    generated = generate_orders(spark, n, securities=securities, start=start)
    if layout == "auto":
        # ids are spread evenly: each security holds about 1 / securities of the orders
        layout = "key" if securities >= partitions else "even"
    cleaned = layout_orders(clean_orders(generated), partitions, layout)
    with persisted(cleaned, level):
        rows = cleaned.count()
        profile = collect_bounded(partition_profile(cleaned, "security_id").orderBy("partition"), partitions)
        out = _daily_outputs(cleaned, preview_rows, parquet_path, jdbc)
    return GeneratedOrdersResult(rows, profile, out.preview, parquet_path)
