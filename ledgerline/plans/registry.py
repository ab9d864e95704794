"""Registered queries over the driver's test tables, with their SQL oracles.

Every query reads whole tables (or data Spark derives from them and writes
to the shared folder); no row caps except where a limit is the feature
(the top-20 preview).  Column names match the oracle SQL exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.aggregate import collect_bounded, count_rows, distinct_rows, with_row_number
from ledgerline.operators.dedup import latest_per_key, latest_per_key_agg
from ledgerline.operators.joins import dimension_join, filtered_join
from ledgerline.operators.layout import coalesce_to, persisted, repartition_by
from ledgerline.operators.profile import hot_keys, key_skew, partition_profile
from ledgerline.operators.quality import deal_corrupt, valid_quotes
from ledgerline.operators.state import DailyState, LatestState
from ledgerline.plans.contacts import contacts_with_full_name, read_contacts
from ledgerline.plans.customer_transactions import (
    bucketed_customer_transactions,
    join_customer_transactions,
    join_customer_transactions_salted,
)
from ledgerline.plans.orders import (
    clean_orders,
    daily_preview,
    enrich_orders,
    layout_orders,
    orders_daily,
    read_daily,
    read_orders_json,
)
from ledgerline.plans.ticks import (
    PARTITION_COLUMNS,
    RAW_TICK_SCHEMA,
    IncrementalTicks,
    parse_ticks,
    process_ticks,
    read_processed,
    with_corrupt,
)
from ledgerline.session import fresh_dir
from ledgerline.sinks.compaction import Manifest, compact_small_files
from ledgerline.sinks.files import (
    write_compacted,
    write_csv,
    write_json_documents,
    write_ndjson,
    write_partitioned,
    write_unless_empty,
)
from ledgerline.sources.files import read_csv, read_json_documents, read_ndjson_tree, read_parquet, string_schema
from ledgerline.sources.generate import generate_orders
from ledgerline.sources.json_arrays import read_json_array
from ledgerline.sources.rows import from_rows
from ledgerline.sources.tables import (
    contacts_from_customer,
    contacts_from_documents,
    customers_from_customer,
    orders_from_lineitem,
    read_test_table,
    ticks_from_events,
    transactions_from_orders,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Digits kept for averages, whose floating sum depends on the combine order.
AVG_DIGITS = 6
#: Files of JSON documents that may be as small as a megabyte.
SMALL_DOCUMENTS = 64
#: Rows of one JSON array that is read in splits, in bytes: one task writes it, several read it.
SPLIT_BYTES = 512 * 1024 * 1024
#: Fixed ingest stamp for registered tick queries (the pipeline default is the query time).
INGEST_TS = "2025-01-01 00:00:00"
#: Day range of the partition-pruning round trip.
PRUNE_FROM, PRUNE_TO = "1996-03-01", "1996-03-31"

# Order status codes of the orders table and their meaning (in-memory dimension).
ORDER_STATUS = [("F", "fulfilled"), ("O", "open"), ("P", "partial")]
ORDER_STATUS_SCHEMA = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("status_name", T.StringType(), False),
])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_test_table(spark, sf_dir, name)


def _orders(spark, sf_dir) -> DataFrame:
    return orders_from_lineitem(_table(spark, sf_dir, "lineitem"))


def _ticks(spark, sf_dir) -> DataFrame:
    return ticks_from_events(_table(spark, sf_dir, "events"))


def _customers(spark, sf_dir) -> DataFrame:
    return customers_from_customer(_table(spark, sf_dir, "customer"))


def _transactions(spark, sf_dir) -> DataFrame:
    return transactions_from_orders(_table(spark, sf_dir, "orders"))


def _ingest() -> F.Column:
    return F.lit(INGEST_TS).cast("timestamp_ntz")


# --- orders ------------------------------------------------------------

def q_order_enrich(spark, sf_dir):
    return enrich_orders(clean_orders(_orders(spark, sf_dir)))


def q_order_daily_agg(spark, sf_dir):
    return orders_daily(_orders(spark, sf_dir), round_digits=AVG_DIGITS)


def q_order_daily_agg_topk(spark, sf_dir):
    return daily_preview(q_order_daily_agg(spark, sf_dir), 20)


def q_orders_clean_count(spark, sf_dir):
    """Orders without price (every seventh line number) or quantity (every fifth key) are dropped."""
    lines = _table(spark, sf_dir, "lineitem").withColumns({
        "l_extendedprice": F.when(F.col("l_linenumber") % 7 != 0, F.col("l_extendedprice")),
        "l_quantity": F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity")),
    })
    return count_rows(clean_orders(orders_from_lineitem(lines)))


def q_layout_agg(spark, sf_dir):
    """Lay orders out over 50 partitions -- by security unless one is hot -- then aggregate;
    by security the aggregate reuses the partitioning (one exchange)."""
    cleaned = layout_orders(clean_orders(_orders(spark, sf_dir)), 50)
    return orders_daily(cleaned, round_digits=AVG_DIGITS)


def q_gen(spark, sf_dir):
    """Generated orders, one per lineitem row (the row count grows with the table)."""
    n = _table(spark, sf_dir, "lineitem").count()
    return generate_orders(spark, n)


def q_rt_parquet_prune(spark, sf_dir):
    daily = q_order_daily_agg(spark, sf_dir)
    path = fresh_dir(spark, "rt_parquet_prune")
    write_partitioned(daily, path, ["trade_date_str"])
    return read_daily(spark, path, daily.schema, PRUNE_FROM, PRUNE_TO)


def q_rt_json_multiline(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    path = fresh_dir(spark, "rt_json_multiline")
    write_json_documents(orders, path, target_bytes=1 << 20, small_files=SMALL_DOCUMENTS)
    return read_json_documents(spark, path, schema=orders.schema)


def q_orders_json_daily(spark, sf_dir):
    """Orders landed as multi-line JSON documents, read back with the order
    schema (instant timestamps), then the daily aggregate."""
    orders = _orders(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    path = fresh_dir(spark, "orders_json")
    write_json_documents(orders, path, target_bytes=1 << 20, small_files=SMALL_DOCUMENTS)
    schema = T.StructType.fromDDL("security_id bigint, price double, quantity bigint, timestamp timestamp")
    return orders_daily(read_orders_json(spark, path, schema), round_digits=AVG_DIGITS)


def q_orders_json_types(spark, sf_dir):
    """Orders whose ids are text and whose quantities are fractions, whole numbers spelt
    ``3.0`` and quoted numbers, read back from JSON documents with the default types."""
    lines = _table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("security_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") + F.when(F.col("l_linenumber") % 2 == 0, 0.5).otherwise(0.0)).alias("quantity"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        (F.col("l_linenumber") % 3 == 0).alias("quoted"),
    )
    base = fresh_dir(spark, "orders_json_types")
    write_json_documents(lines.where("not quoted").drop("quoted"), f"{base}/numbers", target_bytes=1 << 20, small_files=SMALL_DOCUMENTS)
    quoted = lines.where("quoted").drop("quoted").withColumn("quantity", F.col("quantity").cast("string"))
    write_json_documents(quoted, f"{base}/quoted", target_bytes=1 << 20, small_files=SMALL_DOCUMENTS)
    both = read_orders_json(spark, [f"{base}/numbers", f"{base}/quoted"])
    return orders_daily(both, round_digits=AVG_DIGITS)


def q_rt_json_split(spark, sf_dir):
    """All documents as a JSON array in one file (in several, past :data:`SPLIT_BYTES` each), with
    texts that hold quotes, escapes and brackets, read back in splits."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text",
        F.concat(F.lit('{"}],[{\\\\"'), F.col("lang"), F.lit('\\\\}"\n]')).alias("note"),
        F.struct(F.col("source"), F.array("n_chars", "doc_id").alias("sizes")).alias("origin"),
    )
    path = fresh_dir(spark, "rt_json_split")
    write_json_documents(docs, path, target_bytes=SPLIT_BYTES)
    return read_json_array(spark, path, docs.schema).select("doc_id", "text", "note", "origin.source", F.get("origin.sizes", F.lit(0)).alias("n_chars"))


def q_order_daily_incremental(spark, sf_dir):
    """Two half loads (even and odd order keys) merged into stored partial sums per day."""
    lines = _table(spark, sf_dir, "lineitem")
    state = DailyState(spark, fresh_dir(spark, "daily_state"))
    for half in (0, 1):
        orders = orders_from_lineitem(lines.where(F.col("l_orderkey") % 2 == half))
        state.merge(enrich_orders(clean_orders(orders)), f"half-{half}")
    return state.read(AVG_DIGITS)


def q_collect_preview(spark, sf_dir):
    """The preview brought to the driver behind its bound, and back as rows."""
    preview = q_order_daily_agg_topk(spark, sf_dir)
    return from_rows(spark, [tuple(r) for r in collect_bounded(preview, 20)], preview.schema)


def q_persist_reuse(spark, sf_dir):
    """Cleaned orders kept for two actions, a count and a count of groups."""
    with persisted(clean_orders(_orders(spark, sf_dir))) as cleaned:
        n_rows, n_groups = cleaned.count(), orders_daily(cleaned).count()
    return from_rows(spark, [(n_rows, n_groups)], T.StructType.fromDDL("n_rows bigint, n_groups bigint"))


# --- ticks -------------------------------------------------------------

def q_tick_quality(spark, sf_dir):
    """Quotes with a zero, missing or too small ask (by event id) are dropped."""
    by_id = F.col("event_id")
    ask = F.when(by_id % 5 == 0, F.col("bid")).when(by_id % 11 == 0, F.lit(0.0)).when(by_id % 13 != 0, F.col("ask"))
    return valid_quotes(_ticks(spark, sf_dir).withColumn("ask", ask))


def q_tick_latest(spark, sf_dir):
    return latest_per_key(valid_quotes(_ticks(spark, sf_dir)), ["sequence_id"], ["recv_ts"], ["event_id"])


def q_tick_latest_maxby(spark, sf_dir):
    return latest_per_key_agg(valid_quotes(_ticks(spark, sf_dir)), ["sequence_id"], ["recv_ts"], ["event_id"])


def q_tick_enrich(spark, sf_dir):
    return process_ticks(_ticks(spark, sf_dir), ingest_ts=_ingest(), tie_break=["event_id"])


def q_tick_store_rt(spark, sf_dir):
    processed = q_tick_enrich(spark, sf_dir)
    path = fresh_dir(spark, "tick_store")
    write_partitioned(processed, path, PARTITION_COLUMNS)
    return read_processed(spark, path, processed.schema)


def _raw_tick_lines(events: DataFrame) -> DataFrame:
    """Events as raw FX tick JSON objects (text times with ``Z``), plus landing-path columns."""
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    pair = F.concat(F.upper("event_type"), F.lit("/USD"))
    return events.select(
        ts_text.alias("trade_ts"),
        pair.alias("pair"),
        F.col("value").alias("bid"),
        (F.col("value") * F.lit(1.001)).alias("ask"),
        F.col("event_id").cast("string").alias("venue"),
        F.col("user_id").cast("string").alias("sequence_id"),
        F.regexp_replace(pair, "/", "").alias("instrument_id"),
        ts_text.alias("recv_ts"),
        F.year("ts").alias("y"),
        F.date_format("ts", "MM").alias("m"),
        F.date_format("ts", "dd").alias("d"),
    )


def q_tick_ndjson_e2e(spark, sf_dir):
    """Land ticks as NDJSON under y=/m=/d=, then run the ticks job from text."""
    root = fresh_dir(spark, "tick_landing")
    write_ndjson(_raw_tick_lines(_table(spark, sf_dir, "events")), root, ["y", "m", "d"])
    raw = read_ndjson_tree(spark, root, schema=RAW_TICK_SCHEMA, file_glob="*.json")
    out = process_ticks(raw, ingest_ts=INGEST_TS, tie_break=["venue"], time_zone="UTC")
    # parsed instants compared as UTC wall clock; the ingest stamp is a session-zone literal
    utc = {c: F.convert_timezone(None, F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
           for c in ("trade_ts_parsed", "recv_ts_parsed")}
    return out.withColumns({**utc, "ingest_ts": F.col("ingest_ts").cast("timestamp_ntz")})


def _dealt_tick_lines(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Events as lines of JSON, every 17th cut off; read once and dealt into good rows and malformed lines."""
    event = F.to_json(F.struct("event_id", "user_id", "value"))
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "value":'))
    root = fresh_dir(spark, "tick_lines")
    _table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 17 == 0, cut).otherwise(event).alias("value")).write.text(root)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, value double")
    return deal_corrupt(read_ndjson_tree(spark, root, schema=with_corrupt(schema), file_glob="*.txt", corrupt_column="_corrupt_record"))


def q_tick_quarantine_good(spark, sf_dir):
    return _dealt_tick_lines(spark, sf_dir)[0]


def q_tick_quarantine_bad(spark, sf_dir):
    return _dealt_tick_lines(spark, sf_dir)[1].select(F.col("_corrupt_record").alias("line"))


def q_tick_landing_incremental(spark, sf_dir):
    """Ticks land in two parts; each run reads the files that are new, the last one none."""
    lines = _raw_tick_lines(_table(spark, sf_dir, "events"))
    root, store = fresh_dir(spark, "tick_drops"), IncrementalTicks(spark, fresh_dir(spark, "tick_incremental"))
    for part in (0, 1):
        write_ndjson(lines.where(F.col("venue").cast("bigint") % 2 == part).drop("y", "m", "d"), f"{root}/drop={part}")
        store.ingest(root, ingest_ts=INGEST_TS, file_glob="*.json")
    if store.ingest(root, ingest_ts=INGEST_TS, file_glob="*.json"):
        raise RuntimeError("files were read twice")
    typed = parse_ticks(read_ndjson_tree(spark, root, schema=RAW_TICK_SCHEMA), ingest_ts=INGEST_TS)
    utc = F.convert_timezone(None, F.lit("UTC"), F.col("recv_ts_parsed").cast("timestamp_ntz"))
    return store.valid(typed.schema).select("venue", "pair", "bid", "ask", "sequence_id", utc.alias("recv_ts_parsed"))


def q_tick_state_merge(spark, sf_dir):
    """Latest ticks, from three batches merged one after another into the bucketed state."""
    ticks = valid_quotes(_ticks(spark, sf_dir))
    state = LatestState(spark, f"ledgerline_latest_{uuid.uuid4().hex}", "sequence_id", ["recv_ts", "event_id"], buckets=8)
    for part in range(3):
        state.merge(ticks.where(F.col("event_id") % 3 == part))
    return state.read()


def q_tick_ingest_stamp(spark, sf_dir):
    """The query's own time as ingest stamp: one for all rows, not before this call."""
    begun = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    stamped = parse_ticks(_ticks(spark, sf_dir))
    return stamped.agg(
        F.count("ingest_ts").alias("n_stamped"),
        F.count_distinct("ingest_ts").alias("n_stamps"),
        (F.min("ingest_ts") >= F.lit(begun)).alias("not_before"),
    )


def q_guard_empty(spark, sf_dir):
    """Of two results one is empty: only the other is written."""
    ticks, base = _ticks(spark, sf_dir), fresh_dir(spark, "guard_empty")
    rows = []
    for name, df in (("valid", valid_quotes(ticks)), ("none", valid_quotes(ticks).where("ask < bid"))):
        wrote = write_unless_empty(df, lambda d: d.write.parquet(f"{base}/{name}"))  # noqa: B023
        rows.append((name, wrote, spark.read.parquet(f"{base}/{name}").count() if wrote else 0))
    return from_rows(spark, rows, T.StructType.fromDDL("name string, wrote boolean, n_rows bigint"))


def q_rt_ndjson(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    root = fresh_dir(spark, "rt_ndjson")
    landing = events.withColumns({
        "year": F.year("ts"), "month": F.date_format("ts", "MM"), "day": F.date_format("ts", "dd"),
    })
    write_ndjson(landing, root, ["year", "month", "day"])
    return read_ndjson_tree(spark, root, schema=events.schema, file_glob="*.json")


# --- contacts ----------------------------------------------------------

def q_doc_digits(spark, sf_dir):
    return contacts_with_full_name(contacts_from_documents(_table(spark, sf_dir, "documents")))


def _contacts(spark, sf_dir):
    """Contacts of all customers; every third comment holds no digit."""
    contacts = contacts_from_customer(_table(spark, sf_dir, "customer"))
    plain = F.regexp_replace("comment", r"\d", "")
    return contacts.withColumn("comment", F.when(F.col("c_custkey") % 3 == 0, plain).otherwise(F.col("comment")))


def q_text_digits(spark, sf_dir):
    return contacts_with_full_name(_contacts(spark, sf_dir))


def q_contacts_csv_e2e(spark, sf_dir):
    """Contacts written as a header CSV, read back as strings, then the contacts job."""
    path = fresh_dir(spark, "contacts_csv")
    write_csv(_contacts(spark, sf_dir).drop("c_custkey"), path)
    return contacts_with_full_name(read_contacts(spark, path))


def q_contacts_order(spark, sf_dir):
    """The sorted contacts in their partitions: a partition whose smallest name comes before an earlier one's largest is out of order."""
    ordered = contacts_with_full_name(_contacts(spark, sf_dir))
    by_part = ordered.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min("last_name").alias("low"), F.max("last_name").alias("high"), F.count(F.lit(1)).alias("n"))
    ends = by_part.withColumn("before", F.max("high").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    return ends.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("low") < F.col("before")).cast("bigint").alias("out_of_order"))


def q_contacts_rank(spark, sf_dir):
    """Place of each contact in the sorted list, without a one-task window."""
    named = contacts_with_full_name(_contacts(spark, sf_dir))
    return with_row_number(named, ["first_name", F.col("last_name").desc()], "place").select("c_custkey", "full_name", "place")


def q_rt_csv(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    path = fresh_dir(spark, "rt_csv")
    write_csv(customer, path)
    return read_csv(spark, path, schema=string_schema(*customer.columns))


def q_csv_infer(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    path = fresh_dir(spark, "csv_infer")
    write_csv(customer, path)
    inferred = read_csv(spark, path, infer_schema=True)
    # inference picks int for small keys: restore the source types
    return inferred.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in customer.schema.fields])


def q_compact(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    path = fresh_dir(spark, "compact")
    write_compacted(customer, path, target_bytes=1 << 20)
    return read_parquet(spark, path, schema=customer.schema)


def q_compact_small(spark, sf_dir):
    """Orders stored in a folder per status, as many small files, compacted and read through the manifest."""
    orders = _table(spark, sf_dir, "orders")
    path = fresh_dir(spark, "compact_small")
    orders.repartition(12).write.partitionBy("o_orderstatus").parquet(path)
    compact_small_files(spark, path, orders.schema, ["o_orderstatus"], target_bytes=1 << 20)
    manifest = Manifest(spark, path)
    manifest.vacuum()
    return manifest.read(orders.schema)


# --- joins -------------------------------------------------------------

def q_join_inner(spark, sf_dir):
    return join_customer_transactions(_customers(spark, sf_dir), _transactions(spark, sf_dir))


def q_join_bucketed(spark, sf_dir):
    return bucketed_customer_transactions(spark, _customers(spark, sf_dir), _transactions(spark, sf_dir))


def q_join_bucketed_skew(spark, sf_dir):
    # co-bucketed join; customers with at least 0.1 % of all transactions are joined apart, salted
    return bucketed_customer_transactions(
        spark, _customers(spark, sf_dir), _transactions(spark, sf_dir), database="ledgerline_skew",
        min_share=0.001, salt_buckets=8,
    )


def q_join_skew(spark, sf_dir):
    # customers with at least 0.1 % of all transactions are salted
    return join_customer_transactions_salted(
        _customers(spark, sf_dir), _transactions(spark, sf_dir), min_share=0.001, salt_buckets=8
    )


def q_join_key_filter(spark, sf_dir):
    """Transactions of one segment's customers; as if those were too many to broadcast, a filter
    of their keys drops other transactions before the exchange."""
    segment = _customers(spark, sf_dir).where(F.col("segment") == "BUILDING")
    return filtered_join(_transactions(spark, sf_dir), segment, "customer_id", max_rows=1)


def q_dimension_join(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
    )
    nation = _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_key"),
        F.col("n_name").alias("nation_name"),
        F.col("n_regionkey").alias("region_key"),
    )
    return dimension_join(customer, nation, "nation_key")


def q_rows_source(spark, sf_dir):
    status = from_rows(spark, ORDER_STATUS, ORDER_STATUS_SCHEMA)
    txns = _transactions(spark, sf_dir)
    return dimension_join(txns, status, txns["product"] == status["code"]).drop("code")


def q_distinct_segments(spark, sf_dir):
    return distinct_rows(_customers(spark, sf_dir), ["segment"])


# --- profile -----------------------------------------------------------

def q_key_skew(spark, sf_dir):
    return key_skew(_orders(spark, sf_dir), "security_id", digits=8)


def q_hot_keys(spark, sf_dir):
    """Event types with at least a tenth of all events, and users with at least a thousandth."""
    events = _table(spark, sf_dir, "events")
    rows = [("event_type", str(k)) for k in hot_keys(events, "event_type", 0.1)]
    rows += [("user_id", str(k)) for k in hot_keys(events, "user_id", 0.001)]
    return from_rows(spark, rows, T.StructType.fromDDL("column_name string, hot_key string"))


def q_coalesce_rows(spark, sf_dir):
    """Line items in 12 partitions merged into 3 without a shuffle: no row is lost."""
    merged = coalesce_to(_table(spark, sf_dir, "lineitem").select("l_orderkey").repartition(12), 3)
    profile = partition_profile(merged)
    return profile.agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("rows").alias("n_rows"))


def q_partition_rows(spark, sf_dir):
    """Profile of a layout by key: rows, smallest and largest key, and the distinct keys, which no two partitions share."""
    by_key = repartition_by(_table(spark, sf_dir, "lineitem").select("l_partkey"), ["l_partkey"])
    profile = partition_profile(by_key, key="l_partkey", exact_distinct=True)
    return profile.agg(F.sum("rows").alias("n_rows"), F.sum("distinct_keys").alias("n_keys"),
                       F.min("min_key").alias("min_key"), F.max("max_key").alias("max_key"))


QUERIES: dict[str, Query] = {
    "order_enrich": q_order_enrich,
    "order_daily_agg": q_order_daily_agg,
    "order_daily_agg_topk": q_order_daily_agg_topk,
    "orders_clean_count": q_orders_clean_count,
    "layout_agg": q_layout_agg,
    "order_daily_incremental": q_order_daily_incremental,
    "collect_preview": q_collect_preview,
    "persist_reuse": q_persist_reuse,
    "gen": q_gen,
    "rt_parquet_prune": q_rt_parquet_prune,
    "orders_json_daily": q_orders_json_daily,
    "orders_json_types": q_orders_json_types,
    "rt_json_multiline": q_rt_json_multiline,
    "rt_json_split": q_rt_json_split,
    "tick_quality": q_tick_quality,
    "tick_quarantine_good": q_tick_quarantine_good,
    "tick_quarantine_bad": q_tick_quarantine_bad,
    "tick_landing_incremental": q_tick_landing_incremental,
    "tick_state_merge": q_tick_state_merge,
    "tick_ingest_stamp": q_tick_ingest_stamp,
    "guard_empty": q_guard_empty,
    "tick_latest": q_tick_latest,
    "tick_latest_maxby": q_tick_latest_maxby,
    "tick_enrich": q_tick_enrich,
    "tick_store_rt": q_tick_store_rt,
    "tick_ndjson_e2e": q_tick_ndjson_e2e,
    "rt_ndjson": q_rt_ndjson,
    "doc_digits": q_doc_digits,
    "text_digits": q_text_digits,
    "contacts_csv_e2e": q_contacts_csv_e2e,
    "contacts_order": q_contacts_order,
    "contacts_rank": q_contacts_rank,
    "rt_csv": q_rt_csv,
    "csv_infer": q_csv_infer,
    "compact": q_compact,
    "compact_small": q_compact_small,
    "join_inner": q_join_inner,
    "join_bucketed": q_join_bucketed,
    "join_bucketed_skew": q_join_bucketed_skew,
    "join_skew": q_join_skew,
    "dimension_join": q_dimension_join,
    "join_key_filter": q_join_key_filter,
    "rows_source": q_rows_source,
    "distinct_segments": q_distinct_segments,
    "key_skew": q_key_skew,
    "hot_keys": q_hot_keys,
    "partition_rows": q_partition_rows,
    "coalesce_rows": q_coalesce_rows,
}


# --- oracle SQL (DuckDB dialect, views named after the tables) ----------

_ORDERS_CTE = """
WITH orders_src AS (
  SELECT l_partkey AS security_id, l_extendedprice AS price,
         CAST(l_quantity AS INTEGER) AS quantity, l_shipdate AS "timestamp"
  FROM lineitem),
clean AS (SELECT * FROM orders_src WHERE price IS NOT NULL AND quantity IS NOT NULL),
daily AS (
  SELECT security_id, strftime("timestamp", '%Y-%m-%d') AS trade_date_str,
         CAST(sum(quantity) AS BIGINT) AS total_volume,
         round(avg(price), {digits}) AS avg_price
  FROM clean GROUP BY 1, 2)
""".format(digits=AVG_DIGITS)

_TICKS_CTE = """
WITH ticks AS (
  SELECT event_id, user_id AS sequence_id, ts AS trade_ts, ts AS recv_ts,
         upper(event_type) || '/USD' AS pair, value AS bid, value * CAST(1.001 AS DOUBLE) AS ask
  FROM events),
valid AS (SELECT * FROM ticks WHERE bid > 0 AND ask > 0 AND ask > bid),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sequence_id
                                 ORDER BY recv_ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM valid) WHERE rn = 1),
enriched AS (
  SELECT *, trade_ts AS trade_ts_parsed, recv_ts AS recv_ts_parsed,
         TIMESTAMP '{ingest}' AS ingest_ts, (bid + ask) / 2 AS mid_price,
         CAST(year(trade_ts) AS INTEGER) AS "year", strftime(trade_ts, '%m') AS "month",
         strftime(trade_ts, '%d') AS "day", regexp_replace(pair, '/', '_', 'g') AS pair_clean
  FROM latest)
""".format(ingest=INGEST_TS)

_JOIN_SQL = """
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, c.c_mktsegment AS segment,
       CAST(c.c_nationkey AS VARCHAR) AS city, o.o_orderkey AS transaction_id,
       o.o_orderdate AS txn_date, o.o_totalprice AS txn_amount,
       o.o_orderpriority AS channel, o.o_orderstatus AS product
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
"""

_TICK_E2E_SQL = """
WITH raw AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS trade_ts, upper(event_type) || '/USD' AS pair,
         value AS bid, value * CAST(1.001 AS DOUBLE) AS ask, CAST(event_id AS VARCHAR) AS venue,
         CAST(user_id AS VARCHAR) AS sequence_id, upper(event_type) || 'USD' AS instrument_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS recv_ts, ts
  FROM events),
valid AS (SELECT * FROM raw WHERE bid > 0 AND ask > 0 AND ask > bid),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sequence_id
                                 ORDER BY ts DESC NULLS LAST, venue DESC NULLS LAST) AS rn
    FROM valid) WHERE rn = 1)
SELECT trade_ts, pair, bid, ask, venue, sequence_id, instrument_id, recv_ts,
       ts AS trade_ts_parsed, ts AS recv_ts_parsed, TIMESTAMP '{ingest}' AS ingest_ts,
       (bid + ask) / 2 AS mid_price, CAST(year(ts) AS INTEGER) AS "year",
       strftime(ts, '%m') AS "month", strftime(ts, '%d') AS "day",
       regexp_replace(pair, '/', '_', 'g') AS pair_clean
FROM latest
""".format(ingest=INGEST_TS)

ORACLE_SQL: dict[str, str] = {
    "order_enrich": _ORDERS_CTE + """
SELECT security_id, price, quantity, "timestamp", price * quantity AS trade_value,
       strftime("timestamp", '%Y-%m-%d') AS trade_date_str FROM clean""",
    "order_daily_agg": _ORDERS_CTE + "SELECT * FROM daily",
    "order_daily_agg_topk": _ORDERS_CTE + "SELECT * FROM daily ORDER BY trade_date_str, security_id LIMIT 20",
    "orders_clean_count": "SELECT count(*) AS n_rows FROM lineitem WHERE l_linenumber % 7 <> 0 AND l_orderkey % 5 <> 0",
    "layout_agg": _ORDERS_CTE + "SELECT * FROM daily",
    "gen": """
SELECT CAST(id % 1000 AS INTEGER) AS security_id,
       CAST(((id % 2147483647) * 7919 + 13) % 10000 AS DOUBLE) / 100.0 AS price,
       CAST(1 + ((id % 2147483647) * 104729 + 7) % 100 AS INTEGER) AS quantity,
       TIMESTAMP '2025-01-01 00:00:00' + to_seconds(((id % 2147483647) * 15485863 + 11) % 31536000) AS "timestamp"
FROM (SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS id FROM lineitem)""",
    "rt_parquet_prune": _ORDERS_CTE + f"""
SELECT * FROM daily WHERE trade_date_str BETWEEN '{PRUNE_FROM}' AND '{PRUNE_TO}'""",
    "rt_json_multiline": "SELECT * FROM orders",
    "rt_json_split": r"""
SELECT doc_id, text, '{"}],[{\\"' || lang || '\\}"' || chr(10) || ']' AS note, source, n_chars FROM documents""",
    "orders_json_daily": _ORDERS_CTE + "SELECT * FROM daily",
    "orders_json_types": f"""
SELECT 'S' || CAST(l_partkey AS VARCHAR) AS security_id, strftime(l_shipdate, '%Y-%m-%d') AS trade_date_str,
       sum(l_quantity + CASE WHEN l_linenumber % 2 = 0 THEN 0.5 ELSE 0 END)::DOUBLE AS total_volume,
       round(avg(l_extendedprice), {AVG_DIGITS}) AS avg_price
FROM lineitem GROUP BY 1, 2""",
    "tick_quality": _TICKS_CTE + "SELECT * FROM valid WHERE event_id % 5 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0",
    "tick_latest": _TICKS_CTE + "SELECT * FROM latest",
    "tick_latest_maxby": _TICKS_CTE + "SELECT * FROM latest",
    "tick_enrich": _TICKS_CTE + "SELECT * FROM enriched",
    "tick_store_rt": _TICKS_CTE + "SELECT * FROM enriched",
    "tick_ndjson_e2e": _TICK_E2E_SQL,
    "rt_ndjson": "SELECT * FROM events",
    "order_daily_incremental": _ORDERS_CTE + "SELECT * FROM daily",
    "collect_preview": _ORDERS_CTE + "SELECT * FROM daily ORDER BY trade_date_str, security_id LIMIT 20",
    "persist_reuse": _ORDERS_CTE + "SELECT (SELECT count(*) FROM clean) AS n_rows, (SELECT count(*) FROM daily) AS n_groups",
    "tick_quarantine_good": "SELECT event_id, user_id, value FROM events WHERE event_id % 17 <> 0",
    "tick_quarantine_bad": """
SELECT '{"event_id": ' || CAST(event_id AS VARCHAR) || ', "value":' AS line FROM events WHERE event_id % 17 = 0""",
    "tick_landing_incremental": """
SELECT CAST(event_id AS VARCHAR) AS venue, upper(event_type) || '/USD' AS pair, value AS bid,
       value * CAST(1.001 AS DOUBLE) AS ask, CAST(user_id AS VARCHAR) AS sequence_id, ts AS recv_ts_parsed
FROM events WHERE value > 0 AND value * CAST(1.001 AS DOUBLE) > value""",
    "tick_state_merge": _TICKS_CTE + "SELECT * FROM latest WHERE sequence_id IS NOT NULL",
    "tick_ingest_stamp": "SELECT count(*) AS n_stamped, CAST(1 AS BIGINT) AS n_stamps, true AS not_before FROM events",
    "guard_empty": _TICKS_CTE + """
SELECT 'valid' AS name, true AS wrote, count(*) AS n_rows FROM valid
UNION ALL SELECT 'none', false, 0""",
    "contacts_rank": r"""
SELECT c_custkey, c_name || ', ' || c_mktsegment AS full_name,
       row_number() OVER (ORDER BY c_mktsegment, c_name DESC) AS place
FROM customer WHERE c_custkey % 3 <> 0 AND regexp_matches(c_name, '\d+')""",
    "compact_small": "SELECT * FROM orders",
    "join_key_filter": _JOIN_SQL + " WHERE c.c_mktsegment = 'BUILDING'",
    "hot_keys": """
SELECT 'event_type' AS column_name, event_type AS hot_key FROM events
GROUP BY event_type HAVING count(*) >= 0.1 * (SELECT count(*) FROM events)
UNION ALL
SELECT 'user_id', CAST(user_id AS VARCHAR) FROM events
GROUP BY user_id HAVING count(*) >= 0.001 * (SELECT count(*) FROM events)""",
    "coalesce_rows": "SELECT CAST(3 AS BIGINT) AS n_partitions, count(*) AS n_rows FROM lineitem",
    "doc_digits": r"""
SELECT doc_id, source AS last_name, lang AS first_name, text AS comment,
       source || ', ' || lang AS full_name
FROM documents WHERE regexp_matches(text, '\d+')""",
    "text_digits": r"""
SELECT c_custkey, c_name AS last_name, c_mktsegment AS first_name, c_name AS comment,
       c_name || ', ' || c_mktsegment AS full_name
FROM customer WHERE c_custkey % 3 <> 0 AND regexp_matches(c_name, '\d+')""",
    "contacts_csv_e2e": r"""
SELECT c_name AS last_name, c_mktsegment AS first_name, c_name AS comment,
       c_name || ', ' || c_mktsegment AS full_name
FROM customer WHERE c_custkey % 3 <> 0 AND regexp_matches(c_name, '\d+')""",
    "contacts_order": r"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order
FROM customer WHERE c_custkey % 3 <> 0 AND regexp_matches(c_name, '\d+')""",
    "rt_csv": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
    "csv_infer": "SELECT * FROM customer",
    "compact": "SELECT * FROM customer",
    "join_inner": _JOIN_SQL,
    "join_bucketed": _JOIN_SQL,
    "join_bucketed_skew": _JOIN_SQL,
    "join_skew": _JOIN_SQL,
    "dimension_join": """
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, c.c_mktsegment AS segment,
       c.c_nationkey AS nation_key, n.n_name AS nation_name, n.n_regionkey AS region_key
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "rows_source": """
SELECT o.o_orderkey AS transaction_id, o.o_custkey AS customer_id, o.o_orderdate AS txn_date,
       o.o_totalprice AS txn_amount, o.o_orderpriority AS channel, o.o_orderstatus AS product,
       s.status_name
FROM orders o JOIN (VALUES ('F', 'fulfilled'), ('O', 'open'), ('P', 'partial')) AS s(code, status_name)
  ON o.o_orderstatus = s.code""",
    "distinct_segments": "SELECT DISTINCT c_mktsegment AS segment FROM customer",
    "key_skew": """
SELECT l_partkey AS security_id, count(*) AS n_rows,
       round(count(*) / (SELECT count(*) FROM lineitem), 8) AS share
FROM lineitem GROUP BY 1""",
    "partition_rows": """
SELECT count(*) AS n_rows, count(DISTINCT l_partkey) AS n_keys, min(l_partkey) AS min_key, max(l_partkey) AS max_key
FROM lineitem""",
}
