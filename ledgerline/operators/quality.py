"""Row filters: not-null, regex match, quote sanity, malformed-line side output.

All predicates are native expressions, so Catalyst can push them into the
scan (``PushedFilters``) and drop checks on non-nullable columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import ColumnLike, col_of, contains_match
from ledgerline.operators.layout import dealt


def all_not_null(cols: Sequence[ColumnLike]) -> Column:
    return reduce(lambda a, b: a & b, [col_of(c).isNotNull() for c in cols])


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every column in ``cols`` is non-null."""
    return df.filter(all_not_null(cols))


def filter_matches(df: DataFrame, col: ColumnLike, pattern: str = r"\d+") -> DataFrame:
    """Keep rows whose ``col`` contains a match of ``pattern``; null drops."""
    return df.filter(contains_match(col, pattern))


def quote_is_valid(bid: ColumnLike = "bid", ask: ColumnLike = "ask", reject_nan: bool = False) -> Column:
    """``bid > 0 AND ask > 0 AND ask > bid``.

    Nulls fail.  Spark orders NaN above every number, so an ``ask`` of NaN
    passes while a ``bid`` of NaN never does; ``reject_nan`` drops both.
    """
    b, a = col_of(bid), col_of(ask)
    cond = (b > 0) & (a > 0) & (a > b)
    if reject_nan:
        cond = cond & ~F.isnan(b) & ~F.isnan(a)
    return cond


def valid_quotes(df: DataFrame, bid: str = "bid", ask: str = "ask", reject_nan: bool = False) -> DataFrame:
    return df.filter(quote_is_valid(bid, ask, reject_nan))


def split_corrupt(df: DataFrame, corrupt_column: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Split a permissive JSON/CSV read into (good rows, malformed lines).

    The good side no longer carries the corrupt-record column; the bad side
    keeps whole rows (the malformed line in ``corrupt_column`` plus any fields
    that did parse).  Spark refuses raw-file queries whose only column read
    is the corrupt-record column, so consume the good side together with data
    columns (or from a saved copy), not through a bare count.
    """
    flag = F.col(corrupt_column)
    good = df.filter(flag.isNull()).drop(corrupt_column)
    bad = df.filter(flag.isNotNull())
    return good, bad


def deal_corrupt(df: DataFrame, corrupt_column: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """:func:`split_corrupt` with one read of the raw files: (good rows, malformed lines).

    Every line is parsed once and written once, good or bad; both sides come
    from what was written, so they may be counted and used in any way.
    """
    bad, good = dealt(df, F.col(corrupt_column).isNotNull(), "corrupt")
    return good.drop(corrupt_column), bad
