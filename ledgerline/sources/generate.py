"""Deterministic distributed order generator.

Same shape as the reference's synthetic orders (security id, price in
[0, 100), quantity in [1, 100], a timestamp within a year of a start), but
every value is integer arithmetic on the row id instead of ``rand()``: the
result does not change with the partition count and a recomputed task after
an executor loss produces the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Generator constants (own choice; primes keep the sequences spread out).
ID_MODULUS = 2_147_483_647      # ids are reduced first so no product can overflow a long
PRICE_MULTIPLIER = 7919
PRICE_OFFSET = 13
QUANTITY_MULTIPLIER = 104729
QUANTITY_OFFSET = 7
SECOND_MULTIPLIER = 15485863
SECOND_OFFSET = 11
YEAR_SECONDS = 31_536_000


def order_columns(
    id_col: Column,
    securities: int = 1000,
    start: str = "2025-01-01 00:00:00",
    horizon_seconds: int = YEAR_SECONDS,
) -> list[Column]:
    """``security_id, price, quantity, timestamp`` computed from a long id column."""
    reduced = id_col % F.lit(ID_MODULUS)
    seconds = (reduced * SECOND_MULTIPLIER + SECOND_OFFSET) % horizon_seconds
    return [
        (id_col % securities).cast("int").alias("security_id"),
        (((reduced * PRICE_MULTIPLIER + PRICE_OFFSET) % 10000) / F.lit(100.0)).alias("price"),
        (F.lit(1) + (reduced * QUANTITY_MULTIPLIER + QUANTITY_OFFSET) % 100).cast("int").alias("quantity"),
        F.timestamp_add("SECOND", seconds, F.lit(start).cast("timestamp_ntz")).alias("timestamp"),
    ]


def generate_orders(
    spark: SparkSession,
    n: int,
    securities: int = 1000,
    partitions: int | None = None,
    start: str = "2025-01-01 00:00:00",
    horizon_seconds: int = YEAR_SECONDS,
) -> DataFrame:
    """``n`` synthetic orders from ``spark.range`` (no input files, no driver data)."""
    ids = spark.range(0, n, 1, partitions)
    return ids.select(*order_columns(F.col("id"), securities, start, horizon_seconds))
