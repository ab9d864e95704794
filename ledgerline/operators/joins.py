"""Equi-joins: plain, co-bucketed, size-checked broadcast, and salted for hot keys.

The plain join leaves the strategy to Catalyst and adaptive execution: a
side that is small at run time becomes a broadcast, skewed sort-merge
partitions are split.  Broadcasting is only forced behind a size check;
beyond the bound the join stays a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import row_bytes, row_hash
from ledgerline.operators.layout import materialized
from ledgerline.operators.profile import hot_keys

_SALT = "__ledgerline_salt"

#: Default broadcast bounds for a dimension side.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _side(alias: str, name: str) -> Column:
    """Column ``name`` of the side aliased ``alias`` (names may hold dots or spaces)."""
    return F.col(f"{alias}.`{name}`")


def _condition(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [_side(left, k) == _side(right, k) for k in keys])


def inner_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_cols: Sequence[str] | None = None,
    right_cols: Sequence[str] | None = None,
) -> DataFrame:
    """``left ⋈ right`` on equal keys; null keys never match, duplicates multiply.

    Output: the key columns once (taken from the left side), then
    ``left_cols`` and ``right_cols`` (default: all other columns), each read
    through its side's alias.  An empty list takes none of a side's columns.
    A name that both sides would contribute is refused: rename it first.
    """
    keys = _keys(on)
    left_cols = [c for c in (left.columns if left_cols is None else left_cols) if c not in keys]
    right_cols = [c for c in (right.columns if right_cols is None else right_cols) if c not in keys]
    if clash := set(left_cols) & set(right_cols):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    joined = left.alias("l").join(right.alias("r"), _condition("l", "r", keys), "inner")
    return joined.select(
        *[_side("l", k).alias(k) for k in keys],
        *[_side("l", c).alias(c) for c in left_cols],
        *[_side("r", c).alias(c) for c in right_cols],
    )


def bucketed_join(
    spark: SparkSession,
    left_table: str,
    right_table: str,
    on: str | Sequence[str],
    left_cols: Sequence[str] | None = None,
    right_cols: Sequence[str] | None = None,
    hot_side: str | None = None,
    min_share: float = 0.01,
    salt_buckets: int = 32,
) -> DataFrame:
    """:func:`inner_join` of two catalog tables bucketed the same way on ``on``.

    Both scans report their bucketing as output partitioning, so the
    sort-merge join needs no exchange on either side (see
    :func:`ledgerline.operators.layout.write_bucketed`).

    A bucket is read as one partition, so a key holding a large share of a
    side would make one join task do that share of the work, and adaptive
    skew splitting does not apply without an exchange.  With ``hot_side``
    (``"left"`` or ``"right"``, one key column) keys holding at least
    ``min_share`` of that side are found first (:func:`hot_keys`, which
    shuffles no keys) and joined apart with
    :func:`skew_join`'s salting; all other keys keep the exchange-free
    bucketed join.  The union equals the plain join.
    """
    left, right = spark.table(left_table), spark.table(right_table)
    if hot_side is None:
        return inner_join(left, right, on, left_cols, right_cols)
    if hot_side not in ("left", "right"):
        raise ValueError("hot_side must be 'left', 'right' or None")
    keys = _keys(on)
    if len(keys) != 1:
        raise ValueError("hot-key splitting needs a single join key")
    key = keys[0]
    big = right if hot_side == "right" else left
    hot = hot_keys(big, key, min_share)
    if not hot:
        return inner_join(left, right, on, left_cols, right_cols)
    is_hot = F.col(f"`{key}`").isin(hot)
    cold = inner_join(left.filter(~is_hot), right.filter(~is_hot), key, left_cols, right_cols)
    if hot_side == "right":
        hot_part = _salted_join(right.filter(is_hot), left.filter(is_hot), key, hot, right_cols, left_cols, salt_buckets)
    else:
        hot_part = _salted_join(left.filter(is_hot), right.filter(is_hot), key, hot, left_cols, right_cols, salt_buckets)
    return cold.unionByName(hot_part.select(*cold.columns))


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """True when ``df`` has at most ``max_rows`` rows whose measured size
    (fixed widths plus real string lengths) is at most ``max_bytes``.

    One aggregate over all rows: every task sends one row, whatever the size
    of the input, and the total is a proven bound rather than an estimate.
    It reads the whole side once; where that costs more than the broadcast
    saves, leave the choice to adaptive execution, which knows the real
    shuffle sizes.
    """
    probe = df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df.schema)).alias("bytes")
    ).first()
    return probe["rows"] <= max_rows and (probe["bytes"] or 0) <= max_bytes


def dimension_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join a fact table to a dimension, broadcasting the dimension when it
    provably fits (:func:`fits_broadcast`); otherwise a shuffle join that
    adaptive execution may still turn into a broadcast at run time."""
    if fits_broadcast(dim, max_rows, max_bytes):
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)


#: Bits of a key filter at most (16 MiB), bits per key, and hashes of a key.
MAX_FILTER_BITS = 1 << 27
FILTER_BITS_PER_KEY, FILTER_HASHES = 10, 4


def _filter_places(key: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(hashes)]


def key_filter(
    keys: DataFrame,
    key: str,
    max_bits: int = MAX_FILTER_BITS,
    max_fill: float = 0.5,
) -> tuple[DataFrame, int] | None:
    """Bloom filter of the values of ``key``: a one-row frame with an array of
    64-bit words, and its number of bits; ``None`` if it would let too much through.

    Sized by an estimate of the distinct keys (:data:`FILTER_BITS_PER_KEY`
    each, a power of two, ``max_bits`` at most).  One aggregate sets the bits:
    a task sends at most one row per word.  If more than ``max_fill`` of the
    bits are set, a random key passes with a chance of over ``max_fill ** 4``
    and the filter is not worth its cost.
    """
    values = keys.select(F.col(f"`{key}`").alias("key")).where(F.col("key").isNotNull())
    expected = values.agg(F.approx_count_distinct("key", 0.02)).first()[0]
    bits = 1 << max(10, (FILTER_BITS_PER_KEY * expected).bit_length())
    if bits > max_bits:
        bits = 1 << (max_bits.bit_length() - 1)
    place = F.explode(F.array(*_filter_places(F.col("key"), bits, FILTER_HASHES))).alias("place")
    words = values.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("set"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"))
    dense = every.join(words, "word", "left").select("word", F.coalesce("set", F.lit(0).cast("bigint")).alias("set"))
    # at most max_bits / 64 words: kept as one row, so that a plan reads it as a constant
    packed = materialized(dense.agg(F.sort_array(F.collect_list(F.struct("word", "set")))["set"].alias("words")), "key_filter")
    ones = packed.select(F.aggregate("words", F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w))).first()[0]
    return (packed, bits) if ones <= max_fill * bits else None


def may_be_in(key: Column, words: DataFrame, bits: int) -> Column:
    """False only for keys that the filter of :func:`key_filter` does not hold; null for null."""
    array = words.scalar()
    hits = [F.getbit(F.get(array, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1 for p in _filter_places(key, bits, FILTER_HASHES)]
    return F.when(key.isNotNull(), reduce(lambda a, b: a & b, hits))


def filtered_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    fact_cols: Sequence[str] | None = None,
    dim_cols: Sequence[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    max_bits: int = MAX_FILTER_BITS,
) -> DataFrame:
    """:func:`inner_join` of a large ``fact`` and a ``dim`` that holds few of its keys.

    Within the broadcast bounds ``dim`` is broadcast.  Beyond them both sides
    must be shuffled; a filter of the dimension's keys (:func:`key_filter`)
    then drops fact rows without a partner in the scan, before their exchange.
    A filter that came out too full is left away.  ``dim`` is read up to three
    times more (its size, its keys), so give one that is cheap to compute.
    """
    if fact.schema[on].dataType != dim.schema[on].dataType:
        raise ValueError(f"{on} differs in type: {fact.schema[on].dataType}, {dim.schema[on].dataType}")
    if fits_broadcast(dim, max_rows, max_bytes):
        return inner_join(fact, F.broadcast(dim), on, fact_cols, dim_cols)
    found = key_filter(dim, on, max_bits)
    if found:
        fact = fact.where(may_be_in(F.col(f"`{on}`"), *found))
    return inner_join(fact, dim, on, fact_cols, dim_cols)


def row_salt(df: DataFrame, is_hot: Column, salt_buckets: int) -> Column:
    """Salt in ``[0, salt_buckets)`` for hot rows, 0 for the rest: a hash of
    the input partition id and every column, so it is stable under recompute."""
    hashed = row_hash(df.schema, F.spark_partition_id())
    return F.when(is_hot, F.pmod(hashed, F.lit(salt_buckets))).otherwise(F.lit(0).cast("long"))


def skew_join(
    big: DataFrame,
    other: DataFrame,
    on: str,
    big_cols: Sequence[str] | None = None,
    other_cols: Sequence[str] | None = None,
    min_share: float = 0.01,
    salt_buckets: int = 32,
) -> DataFrame:
    """Inner join that splits hot keys of ``big`` over ``salt_buckets`` tasks.

    Keys holding at least ``min_share`` of ``big`` (a bounded list, see
    :func:`hot_keys`) get a salt from a hash of the whole row and its input
    partition.  Exact copies of one row therefore spread over the salts as
    they spread over input splits, and a recomputed task (same split, same
    rows) makes the same choice.  The matching ``other`` rows are copied
    once per salt.  Other keys keep salt 0.  The result equals
    :func:`inner_join` (``big`` plays the left side).
    """
    hot = hot_keys(big, on, min_share)
    if not hot:
        return inner_join(big, other, on, big_cols, other_cols)
    return _salted_join(big, other, on, hot, big_cols, other_cols, salt_buckets)


def _salted_join(
    big: DataFrame,
    other: DataFrame,
    on: str,
    hot: list,
    big_cols: Sequence[str] | None,
    other_cols: Sequence[str] | None,
    salt_buckets: int,
) -> DataFrame:
    """Join on ``(on, salt)``: hot ``big`` rows spread over the salts, the
    matching ``other`` rows copied once per salt; other keys keep salt 0."""
    is_hot = F.col(f"`{on}`").isin(hot)
    big_salted = big.withColumn(_SALT, row_salt(big, is_hot, salt_buckets))
    other_salted = other.withColumn(
        _SALT,
        F.explode(
            F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long")))
            .otherwise(F.array(F.lit(0).cast("long")))
        ),
    )
    big_cols = [c for c in (big.columns if big_cols is None else big_cols) if c != on]
    other_cols = [c for c in (other.columns if other_cols is None else other_cols) if c != on]
    return inner_join(big_salted, other_salted, [on, _SALT], big_cols, other_cols).drop(_SALT)
