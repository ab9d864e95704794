"""Latest row per key.

``row_number() OVER (PARTITION BY key ORDER BY ts DESC, tie_break DESC) = 1``.
Spark plans this with ``WindowGroupLimit``: a partial top-1 per key runs in
every map task *before* the shuffle, so a key holding a third of all rows
still sends at most one row per map task across the network; the final
top-1 runs after the exchange.  ``dropDuplicates`` is not used because it
keeps an arbitrary row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import ColumnLike, col_of
from ledgerline.operators.quality import all_not_null

_RANK = "__ledgerline_rank"

NULL_KEY_MODES = ("collapse", "keep", "drop")


def _desc(c: ColumnLike) -> Column:
    return col_of(c).desc_nulls_last()


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[ColumnLike],
    tie_break: Sequence[ColumnLike] = (),
    null_keys: str = "collapse",
) -> DataFrame:
    """Keep, per ``keys``, the row that is greatest by ``order_by`` then ``tie_break``.

    Order is descending with nulls last.  Without a tie-break, rows equal on
    ``order_by`` are picked arbitrarily (reference behaviour); give a unique
    column to make the result deterministic.

    ``null_keys``: ``"collapse"`` treats all null keys as one group (SQL window
    semantics, as the reference); ``"keep"`` passes null-key rows through
    untouched; ``"drop"`` removes them.
    """
    if null_keys not in NULL_KEY_MODES:
        raise ValueError(f"null_keys must be one of {NULL_KEY_MODES}")
    keys = list(keys)
    ordering = [_desc(c) for c in list(order_by) + list(tie_break)]
    window = Window.partitionBy(*keys).orderBy(*ordering)

    def top1(frame: DataFrame) -> DataFrame:
        return (
            frame.withColumn(_RANK, F.row_number().over(window))
            .filter(F.col(_RANK) == 1)
            .drop(_RANK)
        )

    if null_keys == "collapse":
        return top1(df)
    has_keys = all_not_null(keys)
    deduped = top1(df.filter(has_keys))
    if null_keys == "drop":
        return deduped
    return deduped.unionByName(df.filter(~has_keys))


def latest_per_key_agg(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Same rows as :func:`latest_per_key` (non-null keys, non-null order
    values) through one aggregate: ``max_by(row, (order, tie_break))``.

    The aggregate combines map-side, which suits very wide skew as well; the
    window form is the default because it also defines null ordering.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in list(order_by) + list(tie_break)])
    picked = (
        df.filter(all_not_null(keys))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("__row"))
    )
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)
