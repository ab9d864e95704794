"""Column expressions (all JVM-side built-ins; no Python per row)."""

from ledgerline.functions.columns import (
    calendar_parts,
    col_of,
    contains_match,
    day_string,
    full_name,
    mid_price,
    pair_clean,
    parse_timestamp,
    to_double,
    trade_value,
)

__all__ = [
    "calendar_parts", "col_of", "contains_match", "day_string", "full_name", "mid_price",
    "pair_clean", "parse_timestamp", "to_double", "trade_value",
]
