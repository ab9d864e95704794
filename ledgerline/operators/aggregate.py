"""Aggregations, distinct, counts and ordered previews.

``groupBy().agg()`` plans as partial ``HashAggregate`` (map-side combine) ->
hash exchange on the keys -> final ``HashAggregate``; only one row per key
and map task crosses the network, however hot a key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ColumnLike, col_of, row_hash
from ledgerline.operators.layout import materialized


def daily_volume_price(
    df: DataFrame,
    key: str = "security_id",
    day: str = "trade_date_str",
    quantity: str = "quantity",
    price: str = "price",
    round_digits: int | None = None,
) -> DataFrame:
    """``total_volume = sum(quantity)`` and ``avg_price = avg(price)`` per (key, day).

    The average is unweighted, as in the reference.  ``round_digits`` rounds
    the average for presentation (floating sums depend on the combine order).
    """
    avg_price = F.avg(price)
    if round_digits is not None:
        avg_price = F.round(avg_price, round_digits)
    return df.groupBy(key, day).agg(
        F.sum(quantity).alias("total_volume"),
        avg_price.alias("avg_price"),
    )


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``SELECT DISTINCT cols`` (partial dedup map-side, then final after the shuffle)."""
    return (df.select(*cols) if cols else df).distinct()


def row_count(df: DataFrame) -> int:
    """Global row count (an action)."""
    return df.count()


def collect_bounded(df: DataFrame, max_rows: int) -> list:
    """Bring at most ``max_rows`` rows to the driver; more is an error.

    Reads ``max_rows + 1`` rows at most, so an unexpectedly large result
    fails fast instead of filling the driver.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it to a sink instead")
    return rows


def count_rows(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """Global row count as a one-row DataFrame (lazy)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


_TIE = "__ledgerline_tie"


def sort_by(df: DataFrame, order: Sequence[ColumnLike], split_ties: bool = True) -> DataFrame:
    """Global sort (range-partitioned shuffle, then a local sort per range).

    A range partitioner cannot cut between equal sort keys, so one value
    holding a third of all rows would be sorted by one task.  With
    ``split_ties`` the ordering ends in a hash of the input partition and the
    whole row: equal keys are cut into ranges like any others, and exact
    copies of a row spread as they spread over input splits.  Rows equal on
    ``order`` then come in hash order (their order is undefined anyway);
    the hash is the same when a task is recomputed.
    """
    ordering = [col_of(c) for c in order]
    if not split_ties:
        return df.orderBy(*ordering)
    tie = row_hash(df.schema, F.spark_partition_id())
    return df.withColumn(_TIE, tie).orderBy(*ordering, F.col(_TIE)).drop(_TIE)


def top_n(df: DataFrame, n: int, order: Sequence[ColumnLike]) -> DataFrame:
    """First ``n`` rows by ``order``: planned as ``TakeOrderedAndProject``, a
    per-task top-n merged on one task -- no full sort of the input.

    Give a total order (e.g. day then key) or ties make the preview undefined.
    """
    ordering: list[Column] = [col_of(c) for c in order]
    return df.orderBy(*ordering).limit(n)


_PART, _AT, _BEFORE = "__ledgerline_part", "__ledgerline_at", "__ledgerline_before"


def with_row_number(df: DataFrame, order: Sequence[ColumnLike], name: str = "row_number") -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` as column ``name``, without a one-task window.

    The rows are range-partitioned and sorted, numbered inside their range,
    and written once to the shared folder (the ranges come from a sample, so
    two runs of the sort need not cut alike).  A count per range, at most one
    row per partition, gives each range the number of rows ahead of it; only
    those few counts go through a window and a broadcast.

    Give a total order, as for :func:`top_n`.  Null order values come first
    when ascending.  A hot order value without further keys is one range.
    """
    if clash := {name, _PART, _AT} & set(df.columns):
        raise ValueError(f"columns are taken: {sorted(clash)}")
    placed = df.orderBy(*[col_of(c) for c in order]).withColumns({
        _PART: F.spark_partition_id(),
        # the row's place in its partition: the id's low 33 bits
        _AT: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    })
    ranges = materialized(placed, "row_number")
    counts = ranges.groupBy(_PART).agg(F.count(F.lit(1)).alias(_BEFORE))
    ahead = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum(_BEFORE).over(ahead), F.lit(0)).alias(_BEFORE))
    numbered = ranges.join(F.broadcast(offsets), _PART)
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(_BEFORE) + F.col(_AT) + 1).alias(name))
