"""FX ticks: parse -> quality filter -> latest quote per sequence -> enrich -> layout.

Output columns follow the reference: the raw columns (``bid``/``ask`` as
double) then ``trade_ts_parsed, recv_ts_parsed, ingest_ts, mid_price,
year, month, day, pair_clean``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import (
    calendar_parts,
    mid_price,
    pair_clean,
    parse_timestamp,
    to_double,
)
from ledgerline.operators.dedup import latest_per_key
from ledgerline.operators.quality import deal_corrupt, quote_is_valid, valid_quotes
from ledgerline.sinks.files import is_empty, require_apart, write_compacted, write_partitioned
from ledgerline.operators.state import LatestState
from ledgerline.sources.files import read_ndjson_tree, read_parquet, string_schema
from ledgerline.sources.landing import process_new_files, read_batches

RAW_TICK_COLUMNS = (
    "trade_ts", "pair", "bid", "ask", "venue", "sequence_id", "instrument_id", "recv_ts",
)
#: Raw ticks read as text: a malformed number or time then fails (strict) or
#: becomes null (permissive) per field, instead of nulling the whole line.
RAW_TICK_SCHEMA = string_schema(*RAW_TICK_COLUMNS)
CORRUPT_COLUMN = "_corrupt_record"
PARTITION_COLUMNS = ("year", "month", "day", "pair_clean")


def _ingest_column(ingest_ts: Column | str | dt.datetime | None) -> Column:
    if ingest_ts is None:
        return F.current_timestamp()
    if isinstance(ingest_ts, Column):
        return ingest_ts
    if isinstance(ingest_ts, dt.datetime):
        ingest_ts = ingest_ts.isoformat(sep=" ")
    return F.lit(ingest_ts).cast("timestamp")


def parse_ticks(
    raw: DataFrame,
    strict: bool = True,
    ingest_ts: Column | str | dt.datetime | None = None,
) -> DataFrame:
    """Typed ticks: parsed times, ``bid``/``ask`` as double, ``ingest_ts``.

    ``ingest_ts`` defaults to the query's current time (one value per query);
    pass a fixed value so that several outputs carry the same stamp.
    """
    types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.withColumns({
        "trade_ts_parsed": parse_timestamp("trade_ts", strict, types.get("trade_ts")),
        "recv_ts_parsed": parse_timestamp("recv_ts", strict, types.get("recv_ts")),
        "bid": to_double("bid", strict, types.get("bid")),
        "ask": to_double("ask", strict, types.get("ask")),
        "ingest_ts": _ingest_column(ingest_ts),
    })


def enrich_ticks(ticks: DataFrame, time_zone: str | None = None) -> DataFrame:
    """Mid price, calendar parts of the trade time, cleaned pair.

    Calendar parts follow the session time zone (the reference; pin it to
    UTC) unless ``time_zone`` names the zone whose dates partition the
    output.  A ``timestamp_ntz`` trade time is a wall clock already.
    """
    ts = F.col("trade_ts_parsed")
    if time_zone is not None and isinstance(ticks.schema["trade_ts_parsed"].dataType, T.TimestampType):
        ts = F.convert_timezone(None, F.lit(time_zone), ts.cast("timestamp_ntz"))
    parts = calendar_parts(ts)
    return ticks.withColumns({
        "mid_price": mid_price("bid", "ask"),
        "year": parts["year"],
        "month": parts["month"],
        "day": parts["day"],
        "pair_clean": pair_clean("pair"),
    })


def process_ticks(
    raw: DataFrame,
    strict: bool = True,
    ingest_ts: Column | str | dt.datetime | None = None,
    key: str = "sequence_id",
    tie_break: Sequence[str] = (),
    null_keys: str = "collapse",
    reject_nan: bool = False,
    time_zone: str | None = None,
) -> DataFrame:
    """parse -> ``bid > 0 AND ask > 0 AND ask > bid`` -> latest ``recv_ts`` per
    ``key`` -> mid price, calendar parts, cleaned pair.

    The filter runs before the window, so only valid quotes are shuffled;
    the window keeps a partial top-1 per key on the map side.
    """
    parsed = parse_ticks(raw, strict, ingest_ts)
    valid = parsed.filter(quote_is_valid("bid", "ask", reject_nan))
    latest = latest_per_key(valid, [key], ["recv_ts_parsed"], tie_break, null_keys)
    return enrich_ticks(latest, time_zone)


def raw_tick_schema(spark: SparkSession, raw_root: str, file_glob: str = "*.ndjson") -> T.StructType:
    """The expected raw fields, and all others that the tree holds, with plain values as text."""
    found = read_ndjson_tree(spark, raw_root, file_glob=file_glob, corrupt_column=CORRUPT_COLUMN,
                             options={"primitivesAsString": "true"}).schema
    extra = [f for f in found.fields if f.name not in RAW_TICK_COLUMNS and f.name != CORRUPT_COLUMN]
    return T.StructType([*RAW_TICK_SCHEMA.fields, *extra])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """``schema`` and a text column for malformed lines."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])


def read_processed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    **partition_values: str | int,
) -> DataFrame:
    """Read the partitioned ticks back; equality filters on partition columns
    (``year=2025, month="01"``) prune directories."""
    df = read_parquet(spark, path, schema=schema)
    for name, value in partition_values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


@dataclass
class TicksResult:
    written: bool
    rows: int
    quarantined: int
    output_path: str
    export_path: str | None


def run_ticks(
    spark: SparkSession,
    raw_root: str,
    output_path: str,
    export_path: str | None = None,
    quarantine_path: str | None = None,
    strict: bool = True,
    ingest_ts: Column | str | dt.datetime | None = None,
    tie_break: Sequence[str] = (),
    null_keys: str = "collapse",
    export_file_bytes: int = 256 * 1024 * 1024,
    file_glob: str = "*.ndjson",
    time_zone: str | None = None,
    schema: T.StructType | None = None,
) -> TicksResult:
    """The whole ticks job over a landing tree of NDJSON files.

    * every field of the raw lines reaches the output: without ``schema`` the
      field names are found by a pass over the tree (all values as text);
      with it, those fields are read in one pass and no others;
    * output, export, quarantine and raw root must be apart from each other
      (not equal, inside or around one another, however spelt);

    * nothing to read, or nothing left after processing: nothing is written
      (an existing output is left in place);
    * the main output is Parquet partitioned by year/month/day/pair_clean;
    * the optional export is a few files of about ``export_file_bytes`` at
      ``export_path``, made from the written output so both carry identical
      rows and ingest stamps;
    * with ``quarantine_path`` malformed lines are kept there (JSON rows whose
      ``_corrupt_record`` holds the line).
    """
    require_apart(spark, {"raw_root": raw_root, "output_path": output_path,
                          "export_path": export_path, "quarantine_path": quarantine_path})
    schema = schema or raw_tick_schema(spark, raw_root, file_glob)
    quarantined = 0
    if quarantine_path:
        # one read and parse: good and malformed lines are dealt into two folders
        raw, bad = deal_corrupt(read_ndjson_tree(spark, raw_root, schema=with_corrupt(schema), file_glob=file_glob,
                                                 corrupt_column=CORRUPT_COLUMN), CORRUPT_COLUMN)
        bad.write.mode("overwrite").json(quarantine_path)
        quarantined = bad.count()
    else:
        # a malformed line reads as an all-null row, which the quote filter drops
        raw = read_ndjson_tree(spark, raw_root, schema=schema, file_glob=file_glob)
    # The latest of a non-empty set is not empty, so one valid quote is enough:
    # the check is narrow and stops at the first, and nothing has to be cached.
    if is_empty(valid_quotes(parse_ticks(raw, strict, ingest_ts))):
        return TicksResult(False, 0, quarantined, output_path, None)
    processed = process_ticks(raw, strict, ingest_ts, tie_break=tie_break, null_keys=null_keys,
                              time_zone=time_zone)
    write_partitioned(processed, output_path, PARTITION_COLUMNS)
    written = read_parquet(spark, output_path, schema=processed.schema)
    if export_path:
        write_compacted(written, export_path, target_bytes=export_file_bytes)
    return TicksResult(True, written.count(), quarantined, output_path, export_path)


@dataclass
class IncrementalTicks:
    """Places of an incremental tick store (all below ``root``)."""

    spark: SparkSession
    root: str

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def quotes(self) -> str:
        return f"{self.root}/quotes"

    @property
    def malformed(self) -> str:
        return f"{self.root}/malformed"

    def ingest(
        self,
        raw_root: str,
        schema: T.StructType = RAW_TICK_SCHEMA,
        strict: bool = False,
        file_glob: str = "*.ndjson",
        max_files: int = 10_000,
        ingest_ts: Column | str | dt.datetime | None = None,
        on_batch: Callable[[DataFrame, str], object] | None = None,
    ) -> list[str]:
        """Read the files of ``raw_root`` that no earlier run committed; returns the batches done.

        A batch's valid quotes (typed, one ingest stamp) and malformed lines are
        written under its name, each file read once.  ``on_batch(quotes, batch)``
        may carry the batch further, e.g. into a :class:`LatestState`; it is
        called before the commit, again if a run is repeated.
        """

        def process(paths: list[str], batch: str) -> None:
            lines = read_ndjson_tree(self.spark, paths, schema=with_corrupt(schema), file_glob=file_glob, corrupt_column=CORRUPT_COLUMN)
            good, bad = deal_corrupt(lines, CORRUPT_COLUMN)
            quotes = valid_quotes(parse_ticks(good, strict, ingest_ts))
            quotes.write.mode("overwrite").parquet(f"{self.quotes}/batch={batch}")
            bad.write.mode("overwrite").parquet(f"{self.malformed}/batch={batch}")
            if on_batch:
                on_batch(self.spark.read.schema(quotes.schema).parquet(f"{self.quotes}/batch={batch}"), batch)

        return process_new_files(self.spark, raw_root, self.ledger, process, file_glob, max_files)

    def valid(self, schema: T.StructType) -> DataFrame:
        """Valid quotes of all committed batches."""
        return read_batches(self.spark, self.quotes, self.ledger, schema)


def latest_ticks(spark: SparkSession, table: str, tie_break: Sequence[str] = (), buckets: int | None = None) -> LatestState:
    """Latest quote per sequence, kept as a bucketed table that takes in batch after batch."""
    return LatestState(spark, table, "sequence_id", ("recv_ts_parsed", *tie_break), buckets)
