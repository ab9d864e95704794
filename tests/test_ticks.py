import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.dedup import latest_per_key
from ledgerline.plans.inspect import physical_plan
from ledgerline.plans.ticks import (
    RAW_TICK_SCHEMA,
    parse_ticks,
    process_ticks,
    read_processed,
    run_ticks,
)
from ledgerline.sources.files import read_ndjson_tree


def tick(seq, recv="2025-06-02T10:00:00.000001Z", bid=1.1, ask=1.2, pair="GBP/JPY",
         trade="2025-06-02T10:00:00.000001Z", venue="V1"):
    return {"trade_ts": trade, "pair": pair, "bid": bid, "ask": ask, "venue": venue,
            "sequence_id": seq, "instrument_id": "X", "recv_ts": recv}


EDGE_TICKS = [
    tick("a", recv="2025-06-02T10:00:00Z", bid=1.1, ask=1.2),
    tick("a", recv="2025-06-02T10:00:05Z", bid=1.3, ask=1.4),        # newest of a
    tick("a", recv=None, bid=1.5, ask=1.6),                            # null recv_ts sorts last
    tick("b", bid=0, ask=1.0),                                         # bid 0
    tick("c", bid=-1.0, ask=1.0),                                      # negative
    tick("d", bid=1.0, ask=1.0),                                       # locked
    tick("e", bid=1.2, ask=1.1),                                       # crossed
    tick("f", bid=1.0, ask=None),                                      # ask null
    tick("g", bid=1.0, ask="NaN"),                                     # ask NaN passes
    tick("h", bid="NaN", ask=1.0),                                     # bid NaN fails
    tick(None, recv="2025-06-02T10:00:01Z", bid=2.0, ask=2.1),         # two null keys
    tick(None, recv="2025-06-02T10:00:02Z", bid=2.2, ask=2.3),
    tick("p", pair="EUR/USD/X"),                                       # two slashes
    tick("z", trade="2025-03-01T00:30:00+02:00", recv="2025-03-01T00:30:00+02:00"),
]


def write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        for r in rows:
            fh.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def raw_frame(spark, scratch, rows):
    root = os.path.join(scratch, "raw")
    write_lines(os.path.join(root, "year=2025/month=06/day=02/pair=all/shard=0/t.ndjson"), rows)
    return read_ndjson_tree(spark, root, schema=RAW_TICK_SCHEMA)


def by_seq(df):
    return {r["sequence_id"]: r for r in df.collect()}


def test_landing_tree_any_depth_keeps_data_pair(spark, scratch):
    root = os.path.join(scratch, "raw")
    write_lines(os.path.join(root, "year=2025/month=01/day=01/pair=all/shard=0/a.ndjson"), [tick("x")])
    write_lines(os.path.join(root, "year=2025/month=01/day=02/b.ndjson"), [tick("y", pair="AUD/NZD")])
    write_lines(os.path.join(root, "year=2025/month=01/day=03/ignored.txt"), [tick("w")])
    open(os.path.join(root, "year=2025/month=01/day=02/empty.ndjson"), "w").close()
    df = read_ndjson_tree(spark, root, schema=RAW_TICK_SCHEMA)
    assert df.columns == list(RAW_TICK_SCHEMA.fieldNames())   # no year/month/day/pair from paths
    got = {r["sequence_id"]: r["pair"] for r in df.collect()}
    assert got == {"x": "GBP/JPY", "y": "AUD/NZD"}


def test_quality_filter_and_nan(spark, scratch):
    raw = raw_frame(spark, scratch, EDGE_TICKS)
    out = by_seq(process_ticks(raw, ingest_ts="2025-01-01 00:00:00"))
    assert set(out) == {"a", "g", None, "p", "z"}
    strict_nan = by_seq(process_ticks(raw, reject_nan=True))
    assert "g" not in strict_nan


def test_latest_row_per_sequence(spark, scratch):
    raw = raw_frame(spark, scratch, EDGE_TICKS)
    out = by_seq(process_ticks(raw))
    assert out["a"]["bid"] == 1.3 and out["a"]["ask"] == 1.4
    assert out[None]["bid"] == 2.2                       # null keys collapse into one group


def test_null_key_modes(spark, scratch):
    raw = raw_frame(spark, scratch, EDGE_TICKS)
    keep = process_ticks(raw, null_keys="keep")
    assert keep.filter(F.col("sequence_id").isNull()).count() == 2
    drop = process_ticks(raw, null_keys="drop")
    assert drop.filter(F.col("sequence_id").isNull()).count() == 0
    with pytest.raises(ValueError):
        process_ticks(raw, null_keys="other")


def test_tie_break_makes_choice_deterministic(spark):
    rows = [("k", 1, "t1"), ("k", 1, "t2"), ("k", 1, "t0")]
    df = spark.createDataFrame(rows, "key string, ts int, venue string")
    out = latest_per_key(df, ["key"], ["ts"], ["venue"]).collect()
    assert [r["venue"] for r in out] == ["t2"]


def test_enrich_calendar_parts_utc_and_pair(spark, scratch):
    raw = raw_frame(spark, scratch, EDGE_TICKS)
    out = by_seq(process_ticks(raw))
    z = out["z"]   # 00:30 at +02:00 is the previous day in UTC
    assert (z["year"], z["month"], z["day"]) == (2025, "02", "28")
    assert out["p"]["pair_clean"] == "EUR_USD_X"
    assert out["a"]["mid_price"] == pytest.approx((1.3 + 1.4) / 2)
    cols = process_ticks(raw).columns
    assert cols[-8:] == ["trade_ts_parsed", "recv_ts_parsed", "ingest_ts", "mid_price",
                         "year", "month", "day", "pair_clean"]


def test_calendar_parts_in_a_named_zone(spark, scratch):
    raw = raw_frame(spark, scratch, EDGE_TICKS)
    z = by_seq(process_ticks(raw, time_zone="Europe/Helsinki"))["z"]   # UTC+2 in winter
    assert (z["year"], z["month"], z["day"]) == (2025, "03", "01")
    # a wall-clock (timestamp_ntz) trade time is not shifted
    ntz = spark.sql("SELECT TIMESTAMP_NTZ'2025-03-01 00:30:00' AS trade_ts, TIMESTAMP_NTZ'2025-03-01 00:30:00' "
                    "AS recv_ts, 1.0D AS bid, 2.0D AS ask, 'A/B' AS pair, 's' AS sequence_id")
    row = process_ticks(ntz, ingest_ts="2025-01-01 00:00:00", time_zone="Asia/Tokyo").first()
    assert (row["month"], row["day"]) == ("03", "01")


def test_strict_parse_fails_permissive_drops(spark, scratch):
    rows = [tick("m", bid="abc"), tick("t", trade="not-a-time", recv="not-a-time"), tick("ok")]
    raw = raw_frame(spark, scratch, rows)
    with pytest.raises(Exception):
        process_ticks(raw, strict=True).collect()
    out = by_seq(process_ticks(raw, strict=False))
    assert "m" not in out and "ok" in out
    assert out.get("t") is None or out["t"]["trade_ts_parsed"] is None


def test_partial_top1_before_shuffle(spark, scratch):
    raw = raw_frame(spark, scratch, EDGE_TICKS)
    plan = physical_plan(process_ticks(raw))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_run_ticks_end_to_end(spark, scratch):
    root = os.path.join(scratch, "landing")
    write_lines(os.path.join(root, "year=2025/month=06/day=02/pair=all/shard=0/t.ndjson"),
                [json.dumps(r) for r in EDGE_TICKS] + ['{"trade_ts":"2025-'])
    out = os.path.join(scratch, "processed")
    export = os.path.join(scratch, "processed_export")
    bad = os.path.join(scratch, "quarantine")
    res = run_ticks(spark, root, out, export_path=export, quarantine_path=bad,
                    ingest_ts="2025-01-01 00:00:00")
    assert res.written and res.rows == 5 and res.quarantined == 1
    schema = process_ticks(read_ndjson_tree(spark, root, schema=RAW_TICK_SCHEMA)).schema
    back = read_processed(spark, out, schema, year=2025, month="06")
    assert {r["month"] for r in back.collect()} == {"06"}          # string kept on read-back
    assert "PartitionFilters: [isnotnull(year" in physical_plan(back) or "PartitionFilters" in physical_plan(back)
    exported = spark.read.parquet(export)
    assert exported.count() == 5
    # same rows and stamps in both outputs
    assert sorted(r["ingest_ts"] for r in exported.collect()) == sorted(r["ingest_ts"] for r in
                                                                       spark.read.parquet(out).collect())
    # second run over the existing warehouse overwrites cleanly
    res2 = run_ticks(spark, root, out, export_path=export)
    assert res2.rows == 5
    with pytest.raises(ValueError):
        run_ticks(spark, root, out, export_path=os.path.join(out, "single"))


def test_run_ticks_empty_input_keeps_old_output(spark, scratch):
    root = os.path.join(scratch, "empty_landing")
    os.makedirs(os.path.join(root, "year=2025/month=01/day=01"))
    open(os.path.join(root, "year=2025/month=01/day=01/e.ndjson"), "w").close()
    out = os.path.join(scratch, "kept")
    os.makedirs(out)
    marker = os.path.join(out, "marker")
    open(marker, "w").close()
    res = run_ticks(spark, root, out)
    assert not res.written and os.path.exists(marker)
    # everything filtered away: nothing written either
    root2 = os.path.join(scratch, "all_bad")
    write_lines(os.path.join(root2, "year=2025/x.ndjson"), [tick("b", bid=0, ask=1.0)])
    assert not run_ticks(spark, root2, out).written and os.path.exists(marker)


def test_parse_keeps_typed_timestamps(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-01-02 03:04:05' AS trade_ts, "
                   "TIMESTAMP_NTZ'2025-01-02 03:04:05' AS recv_ts, 1.0D AS bid, 2.0D AS ask")
    parsed = parse_ticks(df, ingest_ts="2025-01-01 00:00:00")
    types = dict(parsed.dtypes)
    assert types["trade_ts_parsed"] == "timestamp_ntz" and types["bid"] == "double"
