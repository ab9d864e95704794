"""Scalar column expressions used by the pipelines.

Each helper returns a ``Column`` built from Spark built-ins, so it stays in
whole-stage code generation and can be pushed or pruned by the optimizer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def col_of(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(last: ColumnLike, first: ColumnLike, sep: str = ", ") -> Column:
    """``last ‖ sep ‖ first``; null when either part is null (SQL ``concat``)."""
    return F.concat(col_of(last), F.lit(sep), col_of(first))


def contains_match(c: ColumnLike, pattern: str = r"\d+") -> Column:
    """True when ``pattern`` is found anywhere in the whole string (Java regex
    ``find``, not a full match); null input gives null, which a filter drops."""
    return col_of(c).rlike(pattern)


def trade_value(price: ColumnLike = "price", quantity: ColumnLike = "quantity") -> Column:
    return col_of(price) * col_of(quantity)


def day_string(ts: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    """Calendar day as a string in the session time zone (pin it to UTC)."""
    return F.date_format(col_of(ts), fmt)


def mid_price(bid: ColumnLike = "bid", ask: ColumnLike = "ask") -> Column:
    return (col_of(bid) + col_of(ask)) / F.lit(2)


def calendar_parts(ts: ColumnLike) -> dict[str, Column]:
    """``year`` (int), ``month`` and ``day`` (two-digit strings) of a timestamp."""
    c = col_of(ts)
    return {
        "year": F.year(c),
        "month": F.date_format(c, "MM"),
        "day": F.date_format(c, "dd"),
    }


def pair_clean(pair: ColumnLike, pattern: str = "/", replacement: str = "_") -> Column:
    """Replace every match of ``pattern`` (``"EUR/USD"`` -> ``"EUR_USD"``)."""
    return F.regexp_replace(col_of(pair), pattern, replacement)


def parse_timestamp(
    c: ColumnLike,
    strict: bool = True,
    source_type: T.DataType | None = None,
) -> Column:
    """ISO-8601 text to timestamp.

    ``strict`` fails the job on malformed text (ANSI, like the reference);
    otherwise malformed text becomes null.  A column that already is a
    timestamp (``source_type``) is returned unchanged, keeping ``timestamp_ntz``.
    """
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)):
        return col_of(c)
    return F.to_timestamp(col_of(c)) if strict else F.try_to_timestamp(col_of(c))


def to_double(c: ColumnLike, strict: bool = True, source_type: T.DataType | None = None) -> Column:
    """Cast to double; ``strict=False`` turns malformed numbers into null."""
    if isinstance(source_type, T.DoubleType):
        return col_of(c)
    return col_of(c).cast("double") if strict else col_of(c).try_cast("double")


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    return False


def row_hash(schema: T.StructType, *leading: Column) -> Column:
    """64-bit hash of ``leading`` columns and every column of ``schema``.

    Spark does not hash maps, so a column that is or holds a map is hashed
    through its JSON text; every other column is hashed as it is.
    """
    cols = [F.to_json(F.col(f"`{f.name}`")) if _has_map(f.dataType) else F.col(f"`{f.name}`")
            for f in schema.fields]
    return F.xxhash64(*leading, *cols)


def _fixed_width(dt: T.DataType) -> int:
    if isinstance(dt, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, T.DecimalType):
        return 16
    return 8


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of one row: fixed widths plus the real length of every string,
    binary or nested value (nested values measured as their JSON text)."""
    fixed = 0
    measured: list[Column] = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            measured.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            measured.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            fixed += _fixed_width(f.dataType)
    return reduce(lambda a, b: a + b, measured, F.lit(fixed).cast("long"))
