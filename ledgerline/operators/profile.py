"""Data-shape reports: per-partition profile, per-key skew, hot keys.

All are aggregates that Spark distributes; the only value brought to the
driver is :func:`hot_keys`, whose length is bounded by ``1 / min_share``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.aggregate import collect_bounded


def partition_profile(df: DataFrame, key: str | None = None, exact_distinct: bool = False) -> DataFrame:
    """One row per input partition: ``partition, rows[, distinct_keys, min_key, max_key]``.

    The partition id is taken in the input stage, so the report describes
    how ``df`` is partitioned; the aggregate combines map-side, so only one
    row per partition is shuffled.  ``distinct_keys`` is a HyperLogLog
    estimate unless ``exact_distinct``.
    """
    tagged = df.select(F.spark_partition_id().alias("partition"), *([F.col(key)] if key else []))
    aggs = [F.count(F.lit(1)).alias("rows")]
    if key:
        distinct = F.count_distinct(key) if exact_distinct else F.approx_count_distinct(key)
        aggs += [distinct.alias("distinct_keys"), F.min(key).alias("min_key"), F.max(key).alias("max_key")]
    return tagged.groupBy("partition").agg(*aggs)


def key_skew(df: DataFrame, key: str, digits: int | None = 8) -> DataFrame:
    """Rows per key and each key's share of all rows: ``key, n_rows, share``.

    The total is a scalar subquery over the per-key counts (one number,
    broadcast by Spark; the counts' shuffle is reused, so the input is read
    once), not a global window that would pull every key into one task.
    """
    counts = df.groupBy(F.col(f"`{key}`").alias(key)).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.select(F.sum("n_rows")).scalar()
    share = F.col("n_rows") / total
    if digits is not None:
        share = F.round(share, digits)
    return counts.select(F.col(f"`{key}`"), "n_rows", share.alias("share"))


#: Smallest share that the frequent-item summary can be asked for.
_LEAST_SHARE = 1e-4


def hot_keys(df: DataFrame, key: str, min_share: float = 0.01, nulls: bool = False) -> list:
    """Keys holding at least ``min_share`` of all rows; with ``nulls`` the null key, too.

    Found without shuffling the keys.  First every task keeps a Misra-Gries
    summary of ``2 / min_share`` counters, and the summaries are merged
    (``freqItems``): a key that is frequent enough cannot fall out of one, so
    the merged summary holds all hot keys and at most ``2 / min_share`` others.
    Then those candidates are counted exactly: a task sends a count per
    candidate, and one for all other rows.  The key column is read twice.

    At most ``floor(1 / min_share)`` keys can reach that share, so the list
    brought to the driver has a proven size bound.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    keys = df.select(F.col(f"`{key}`").alias("key"))
    if min_share / 2 < _LEAST_SHARE:
        report = key_skew(keys, "key", digits=None).where((F.col("share") >= min_share) & (F.lit(nulls) | F.col("key").isNotNull()))
        return [row[0] for row in collect_bounded(report.select("key"), math.floor(1 / min_share))]
    items = keys.stat.freqItems(["key"], min_share / 2)
    candidates = items.select(F.explode("key_freqItems").alias("candidate"))
    # at most 2 / min_share rows: bounded by the parameter
    marked = keys.join(F.broadcast(candidates), keys["key"] == candidates["candidate"], "left")
    counted = marked.groupBy("candidate", keys["key"].isNull().alias("none")).agg(F.count(F.lit(1)).alias("n_rows"))
    rows = collect_bounded(counted, math.floor(2 / min_share) + 2)
    least = min_share * sum(r["n_rows"] for r in rows)
    hot = [r for r in rows if r["n_rows"] >= least and (r["candidate"] is not None or r["none"])]
    return [r["candidate"] for r in hot if nulls or not r["none"]]
