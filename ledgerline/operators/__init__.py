"""Relational operators composed from Spark DataFrame built-ins."""

from ledgerline.operators.aggregate import (
    collect_bounded,
    count_rows,
    daily_volume_price,
    distinct_rows,
    row_count,
    sort_by,
    top_n,
)
from ledgerline.operators.dedup import latest_per_key, latest_per_key_agg
from ledgerline.operators.joins import (
    bucketed_join,
    dimension_join,
    fits_broadcast,
    inner_join,
    row_salt,
    skew_join,
)
from ledgerline.operators.layout import (
    checkpointed,
    coalesce_to,
    materialized,
    persisted,
    repartition_by,
    write_bucketed,
)
from ledgerline.operators.profile import hot_keys, key_skew, partition_profile
from ledgerline.operators.quality import (
    filter_matches,
    quote_is_valid,
    require_not_null,
    split_corrupt,
    valid_quotes,
)

__all__ = [
    "bucketed_join", "checkpointed", "coalesce_to", "collect_bounded", "count_rows", "daily_volume_price",
    "dimension_join", "distinct_rows", "filter_matches", "fits_broadcast", "hot_keys",
    "inner_join", "key_skew", "latest_per_key", "latest_per_key_agg", "materialized",
    "partition_profile", "persisted", "quote_is_valid", "repartition_by", "require_not_null",
    "row_count", "row_salt", "skew_join", "sort_by", "split_corrupt", "top_n", "valid_quotes",
    "write_bucketed",
]
