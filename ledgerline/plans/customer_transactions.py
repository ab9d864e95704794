"""Customers ⋈ transactions: plain join and join over co-bucketed tables."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.joins import bucketed_join, inner_join, skew_join
from ledgerline.operators.layout import write_bucketed
from ledgerline.plans.inspect import estimated_bytes
from ledgerline.session import bucket_count, fresh_dir, shared_dir
from ledgerline.sources.catalog import drop_table, ensure_database
from ledgerline.sources.files import read_csv, string_schema

KEY = "customer_id"
CUSTOMER_COLUMNS = ("customer_id", "customer_name", "segment", "city")
TRANSACTION_COLUMNS = ("transaction_id", "customer_id", "txn_date", "txn_amount", "channel", "product")
CUSTOMER_SCHEMA = string_schema(*CUSTOMER_COLUMNS)
TRANSACTION_SCHEMA = string_schema(*TRANSACTION_COLUMNS)

_LEFT = [c for c in CUSTOMER_COLUMNS if c != KEY]
_RIGHT = [c for c in TRANSACTION_COLUMNS if c != KEY]


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema=CUSTOMER_SCHEMA)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema=TRANSACTION_SCHEMA)


def join_customer_transactions(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """The nine output columns, ``customer_id`` once (from the customer side)."""
    return inner_join(customers, transactions, KEY, _LEFT, _RIGHT)


def join_customer_transactions_salted(
    customers: DataFrame,
    transactions: DataFrame,
    min_share: float = 0.01,
    salt_buckets: int = 32,
) -> DataFrame:
    """Same rows; customers holding ``min_share`` of all transactions are
    spread over ``salt_buckets`` tasks."""
    joined = skew_join(transactions, customers, KEY, _RIGHT, _LEFT, min_share, salt_buckets)
    return joined.select(*CUSTOMER_COLUMNS, *_RIGHT)


def write_bucketed_pair(
    spark: SparkSession,
    customers: DataFrame,
    transactions: DataFrame,
    database: str = "ledgerline_demo",
    buckets: int | None = None,
    base_path: str | None = None,
) -> tuple[str, str]:
    """Write both sides bucketed ``buckets`` ways by ``customer_id`` and sorted.

    Without ``buckets`` there are enough for about 1 GiB of the larger side in
    each, by the optimizer's size estimate of the inputs.

    Tables are external, at fresh paths under ``base_path`` (default: the
    shared folder), so re-running in a new session over old files works.
    Returns the two qualified table names.
    """
    if buckets is None:
        buckets = bucket_count(max(estimated_bytes(customers), estimated_bytes(transactions)))
    base = base_path or fresh_dir(spark, "bucketed")
    ensure_database(spark, database, location=shared_dir(spark, "warehouse", f"{database}.db"))
    names = (f"{database}.customers_bucketed", f"{database}.transactions_bucketed")
    for name, frame, folder in zip(names, (customers, transactions), ("customers", "transactions")):
        drop_table(spark, name)
        write_bucketed(frame, name, KEY, buckets=buckets, path=f"{base}/{folder}")
    return names


def bucketed_customer_transactions(
    spark: SparkSession,
    customers: DataFrame,
    transactions: DataFrame,
    database: str = "ledgerline_demo",
    buckets: int | None = None,
    base_path: str | None = None,
    min_share: float | None = 0.01,
    salt_buckets: int = 32,
) -> DataFrame:
    """Bucket both sides, then join the tables: no exchange on either side.

    Customers holding ``min_share`` of all transactions are joined apart over
    ``salt_buckets`` tasks (see :func:`bucketed_join`); ``None`` joins all alike.
    """
    left, right = write_bucketed_pair(spark, customers, transactions, database, buckets, base_path)
    if min_share is None:
        return bucketed_join(spark, left, right, KEY, _LEFT, _RIGHT)
    return bucketed_join(spark, left, right, KEY, _LEFT, _RIGHT, hot_side="right",
                         min_share=min_share, salt_buckets=salt_buckets)


@dataclass
class JoinComparison:
    plain_rows: int
    bucketed_rows: int
    plain_sec: float
    bucketed_sec: float


def compare_join_strategies(
    spark: SparkSession,
    customers: DataFrame,
    transactions: DataFrame,
    database: str = "ledgerline_demo",
    buckets: int | None = None,
    base_path: str | None = None,
    min_share: float | None = None,
) -> JoinComparison:
    """Run the plain join and the join over bucketed tables to completion
    (row counts) and time both; the counts must agree.  ``min_share`` joins
    customers holding that share of all transactions apart (salted)."""
    t0 = time.perf_counter()
    plain = join_customer_transactions(customers, transactions).count()
    t1 = time.perf_counter()
    left, right = write_bucketed_pair(spark, customers, transactions, database, buckets, base_path)
    t2 = time.perf_counter()
    hot = {} if min_share is None else {"hot_side": "right", "min_share": min_share}
    bucketed = bucketed_join(spark, left, right, KEY, _LEFT, _RIGHT, **hot).count()
    t3 = time.perf_counter()
    return JoinComparison(plain, bucketed, round(t1 - t0, 3), round(t3 - t2, 3))
