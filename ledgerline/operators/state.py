"""State that takes in batch after batch: the latest row per key, and partial aggregates per day.

Both keep what a new batch cannot change out of the shuffle: the latest rows
lie bucketed by key and are merged bucket by bucket; the partial sums lie in a
folder per day, and only days that a batch touches are read and replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.aggregate import collect_bounded
from ledgerline.operators.dedup import latest_per_key
from ledgerline.operators.layout import materialized
from ledgerline.plans.inspect import estimated_bytes
from ledgerline.session import bucket_count
from ledgerline.sources.landing import path_exists

_OLD = "__ledgerline_old_"


class LatestState:
    """Latest row per key (:func:`latest_per_key`), kept in a bucketed table.

    ``merge`` reduces a batch to its latest rows, shuffles only those to the
    buckets, and joins them with the stored rows, which stay where they are:
    no exchange on the state's side.  The result is a new table of as many
    buckets; a view by the state's name is then turned to it, so readers see
    the old rows or the new ones, and a run that fails before changes nothing.
    Merging a batch again changes nothing either.

    ``order_by`` should be a total order of a key's rows, its null values
    last.  Rows without a key are left out.
    """

    def __init__(self, spark: SparkSession, table: str, key: str, order_by: Sequence[str], buckets: int | None = None):
        self.spark, self.table, self.key, self.order_by, self.buckets = spark, table, key, list(order_by), buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def _current(self) -> str | None:
        """The table that the view shows."""
        if not self.exists():
            return None
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").where("key = 'ledgerline.table'").first()["value"]

    def _buckets_of(self, table: str) -> int:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'")
        return int(rows.first()["data_type"])

    def merged(self, batch: DataFrame) -> DataFrame:
        """The stored rows with ``batch`` merged in; stored rows are not exchanged."""
        key, names, current = F.col(f"`{self.key}`"), batch.columns, self._current()
        if current is not None and set(names) != set(self.read().columns):
            raise ValueError(f"the batch and {self.table} differ in columns")
        newest = latest_per_key(batch, [self.key], self.order_by, null_keys="drop")
        if current is None:
            return newest
        buckets = self.buckets or self._buckets_of(current)
        # bucketed like the state, so that the join finds both sides in place
        newest = newest.repartition(buckets, self.key)
        stored = self.spark.table(current).select(*[F.col(f"`{c}`").alias(_OLD + c) for c in names])
        both = stored.join(newest, F.col(f"`{_OLD}{self.key}`") == key, "full_outer")
        keep = F.col(f"`{_OLD}{self.key}`").isNotNull() & (key.isNull() | ~self._later())
        return both.select(*[F.when(keep, F.col(f"`{_OLD}{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in names])

    def _later(self) -> Column:
        """Whether the new row comes after the stored one: greater in the first order value that differs."""
        later = F.lit(False)
        for c in reversed(self.order_by):
            new, old = F.col(f"`{c}`"), F.col(f"`{_OLD}{c}`")
            after = F.coalesce(new > old, new.isNotNull())  # nulls last
            later = F.when(new.eqNullSafe(old), later).otherwise(after)
        return later

    def merge(self, batch: DataFrame) -> None:
        current = self._current()
        rows = self.merged(batch)
        if current is not None:
            buckets = self._buckets_of(current)
        else:
            buckets = self.buckets or bucket_count(estimated_bytes(batch))
            rows = rows.repartition(buckets, self.key)
        name = f"{self.table}_{uuid.uuid4().hex}"
        rows.write.bucketBy(buckets, self.key).sortBy(self.key).saveAsTable(name)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.table} TBLPROPERTIES ('ledgerline.table' = '{name}') AS SELECT * FROM {name}")
        if current is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {current}")

    def drop(self) -> None:
        current = self._current()
        if current is not None:
            self.spark.sql(f"DROP VIEW {self.table}")
            self.spark.sql(f"DROP TABLE IF EXISTS {current}")


class DailyState:
    """Partial sums per (key, day), in a folder per day: ``sum(quantity)``, ``sum(price)`` and ``count(price)``.

    ``merge`` aggregates a batch, reads the stored sums of the days that it
    touches (other folders are pruned), adds them up and replaces those folders.
    Stored rows name the batch merged last: a merge that broke off and is
    repeated under its name leaves out the days it had replaced, so no row
    counts twice.  Batches must come one after another.

    Spark replaces a day's folder when the write commits; until then, and in
    other folders, readers see the old sums.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "security_id", day: str = "trade_date_str", quantity: str = "quantity", price: str = "price", max_days: int = 100_000):
        self.spark, self.path, self.key, self.day = spark, path, key, day
        self.quantity, self.price, self.max_days = quantity, price, max_days

    def _stored(self, schema: T.StructType) -> DataFrame:
        if path_exists(self.spark, self.path):
            return self.spark.read.schema(schema).parquet(self.path)
        return self.spark.createDataFrame([], schema)

    def _partial(self, rows: DataFrame, batch: str) -> DataFrame:
        return rows.groupBy(self.key, self.day).agg(
            F.sum(self.quantity).alias("quantity_sum"),
            F.sum(self.price).alias("price_sum"),
            F.count(self.price).alias("price_count"),
        ).select(self.key, "quantity_sum", "price_sum", "price_count", F.lit(batch).alias("last_batch"), self.day)

    def touched(self, partial: DataFrame) -> DataFrame:
        """Stored rows of the days of ``partial``; the list of days prunes the folders."""
        days = [r[0] for r in collect_bounded(partial.select(self.day).distinct(), self.max_days)]
        wanted = F.col(self.day).isin([d for d in days if d is not None])
        if None in days:  # orders without a day have a folder, too
            wanted = wanted | F.col(self.day).isNull()
        return self._stored(partial.schema).where(wanted)

    def merge(self, rows: DataFrame, batch: str) -> None:
        """Add the rows of ``batch``: ``key, day, quantity, price``."""
        partial = materialized(self._partial(rows, batch), "daily_state")
        if partial.isEmpty():
            return
        stored = self.touched(partial)
        replaced = stored.where(F.col("last_batch") == batch).select(F.col(self.day).alias("__day")).distinct()
        both = stored.unionByName(partial)
        both = both.join(F.broadcast(replaced), F.col(self.day).eqNullSafe(F.col("__day")), "left_anti")  # at most max_days days
        sums = both.groupBy(self.key, self.day).agg(*[F.sum(c).alias(c) for c in ("quantity_sum", "price_sum", "price_count")])
        out = sums.select(self.key, "quantity_sum", "price_sum", "price_count", F.lit(batch).alias("last_batch"), self.day)
        out.hint("rebalance", self.day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.day).parquet(self.path)

    def read(self, round_digits: int | None = None) -> DataFrame:
        """``key, day, total_volume, avg_price`` from the stored sums."""
        found = self.spark.read.parquet(self.path).schema
        # folder names stay text
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == self.day else f for f in found])
        average = F.col("price_sum") / F.col("price_count")
        if round_digits is not None:
            average = F.round(average, round_digits)
        return self._stored(schema).select(self.key, self.day, F.col("quantity_sum").alias("total_volume"), average.alias("avg_price"))
