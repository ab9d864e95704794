"""In-memory rows with an explicit schema (small lookup tables)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Largest row list accepted: the rows travel inside the plan, so they must stay small.
MAX_INLINE_ROWS = 100_000


def from_rows(
    spark: SparkSession,
    rows: Iterable[Sequence],
    schema: T.StructType | str,
) -> DataFrame:
    """``createDataFrame(rows, schema)`` with a size bound on the driver-side list."""
    data = [tuple(r) for r in rows]
    if len(data) > MAX_INLINE_ROWS:
        raise ValueError(
            f"{len(data)} in-memory rows; write them to a file source instead "
            f"(limit {MAX_INLINE_ROWS})"
        )
    return spark.createDataFrame(data, schema)
