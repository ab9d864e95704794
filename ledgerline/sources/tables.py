"""The driver's test tables, and their mapping onto the reference's datasets.

The reference reads orders, FX ticks, customers, transactions and contacts
that are not shipped with it.  The given star-schema tables stand in for
them; each mapping is a single projection, so column pruning and filter
pushdown still reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Orders ``security_id, price, quantity, timestamp`` (reference order schema).

    ``l_quantity`` holds whole numbers; it becomes the reference's ``int``.
    """
    return lineitem.select(
        F.col("l_partkey").alias("security_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").alias("timestamp"),
    )


def ticks_from_events(events: DataFrame) -> DataFrame:
    """FX ticks: one quote per event, keyed by ``sequence_id``.

    ``bid`` is the event value and ``ask`` sits 0.1 % above it; receive and
    trade time are the event time; ``event_id`` is kept as a tie-break.
    """
    return events.select(
        F.col("event_id"),
        F.col("user_id").alias("sequence_id"),
        F.col("ts").alias("trade_ts"),
        F.col("ts").alias("recv_ts"),
        F.concat(F.upper(F.col("event_type")), F.lit("/USD")).alias("pair"),
        F.col("value").alias("bid"),
        (F.col("value") * F.lit(1.001)).alias("ask"),
    )


def customers_from_customer(customer: DataFrame) -> DataFrame:
    """Customers ``customer_id, customer_name, segment, city``."""
    return customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("city"),
    )


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """Transactions ``transaction_id, customer_id, txn_date, txn_amount, channel, product``."""
    return orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("txn_date"),
        F.col("o_totalprice").alias("txn_amount"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("product"),
    )


def contacts_from_documents(documents: DataFrame) -> DataFrame:
    """Contacts ``last_name, first_name, comment`` with a whole document as comment."""
    return documents.select(
        F.col("doc_id"),
        F.col("source").alias("last_name"),
        F.col("lang").alias("first_name"),
        F.col("text").alias("comment"),
    )


def contacts_from_customer(customer: DataFrame) -> DataFrame:
    """Contacts ``last_name, first_name, comment`` from customer names and segments."""
    return customer.select(
        F.col("c_custkey"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("comment"),
    )
