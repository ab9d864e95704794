"""Landing ledger, one-read quarantine, and state that takes in batches."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.dedup import latest_per_key
from ledgerline.operators.layout import dealt
from ledgerline.operators.quality import deal_corrupt
from ledgerline.operators.state import DailyState, LatestState
from ledgerline.plans.ticks import IncrementalTicks, latest_ticks, process_ticks, with_corrupt, RAW_TICK_SCHEMA
from ledgerline.sinks.files import write_ndjson
from ledgerline.sources.files import read_ndjson_tree
from ledgerline.sources.landing import FileLedger, list_files, process_new_files

TICK = '{{"trade_ts":"2025-01-0{d}T10:00:00Z","pair":"EUR/USD","bid":"1.0","ask":"{a}","venue":"v{i}","sequence_id":"{s}","instrument_id":"x","recv_ts":"2025-01-0{d}T10:00:{t:02d}Z"}}'


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def land(path, name, lines):
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


# --- one read, two sides -------------------------------------------------

def test_deal_corrupt_reads_the_tree_once(spark, scratch):
    land(f"{scratch}/raw/a", "1.ndjson", [TICK.format(d=1, a="1.5", i=1, s=1, t=1), '{"bid": ', TICK.format(d=1, a="0.5", i=2, s=1, t=2)])
    land(f"{scratch}/raw/b", "2.ndjson", ["not json", "", TICK.format(d=2, a="1.5", i=3, s=2, t=3)])
    lines = read_ndjson_tree(spark, f"{scratch}/raw", schema=with_corrupt(RAW_TICK_SCHEMA), corrupt_column="_corrupt_record")
    good, bad = deal_corrupt(lines)
    assert good.columns == RAW_TICK_SCHEMA.names and good.count() == 3
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["not json", '{"bid": ']
    for side in (good, bad):  # both come from what was written, each from its own folder
        assert "FileScan json" not in plan_of(side) and "PartitionFilters: [" in plan_of(side)


def test_dealt_nulls_and_empty_sides(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "a int, f boolean")
    yes, no = dealt(rows, F.col("f"))
    assert [r["a"] for r in yes.collect()] == [1] and sorted(r["a"] for r in no.collect()) == [2, 3] and yes.columns == ["a", "f"]
    yes, no = dealt(rows.where("a > 5"), F.col("f"))
    assert yes.count() == no.count() == 0
    with pytest.raises(ValueError):
        dealt(rows.withColumn("__ledgerline_side", F.lit(1)), F.col("f"))


# --- ledger --------------------------------------------------------------

def test_only_new_and_changed_files_are_read(spark, scratch):
    seen = []
    run = lambda **o: process_new_files(spark, f"{scratch}/raw", f"{scratch}/ledger", lambda paths, batch: seen.append((batch, sorted(p[-1:] for p in paths))), **o)
    assert run() == [] and not seen  # no tree yet
    for name in "abc":
        land(f"{scratch}/raw/{name}", name, [name])
    assert len(run(max_files=2)) == 2 and sorted(sum((s[1] for s in seen), [])) == ["a", "b", "c"]
    assert run() == []
    land(f"{scratch}/raw/d", "d", ["d"])
    land(f"{scratch}/raw/a", "a", ["a longer one"])
    run()
    assert seen[-1][1] == ["a", "d"] and len(seen) == 3
    done = FileLedger(spark, f"{scratch}/ledger").done()
    assert done.count() == 5 and done.select("batch").distinct().count() == 3


def test_a_batch_that_broke_off_is_repeated_under_its_name(spark, scratch):
    land(f"{scratch}/raw", "a", ["1"])
    calls = []

    def broken(paths, batch):
        calls.append((batch, len(paths)))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        process_new_files(spark, f"{scratch}/raw", f"{scratch}/ledger", broken)
    land(f"{scratch}/raw", "b", ["2"])  # lands in between
    process_new_files(spark, f"{scratch}/raw", f"{scratch}/ledger", lambda paths, batch: calls.append((batch, len(paths))))
    assert calls[1] == calls[0] and calls[2][1] == 1 and calls[2][0] != calls[0][0]
    assert FileLedger(spark, f"{scratch}/ledger").open_files().count() == 0


def test_listing_reads_no_contents(spark, scratch):
    land(f"{scratch}/raw/x=1", "a.txt", ["12345"])
    files = list_files(spark, scratch, "*.txt")
    assert files.count() == 1 and files.first()["length"] == 6 and "content" not in plan_of(files).split("ReadSchema")[1]


def test_incremental_ticks_equal_the_whole_job(spark, scratch):
    rng = random.Random(4)
    lines = [TICK.format(d=rng.randint(1, 3), a=rng.choice(["1.5", "0.5", "2"]), i=i, s=rng.randint(1, 9), t=rng.randint(0, 59)) for i in range(120)]
    store = IncrementalTicks(spark, f"{scratch}/store")
    state = latest_ticks(spark, f"latest_{uuid.uuid4().hex}", ("venue",), buckets=4)
    fail = [True]

    def carry(quotes, batch):
        state.merge(quotes)
        if fail.pop() if fail else False:
            raise RuntimeError("lost")

    run = lambda: store.ingest(f"{scratch}/raw", on_batch=carry, ingest_ts="2025-01-01 00:00:00")
    land(f"{scratch}/raw/day=1", "1.ndjson", lines[:50] + ["broken"])
    with pytest.raises(RuntimeError):
        run()  # everything was written, nothing committed
    assert len(run()) == 1 and run() == []
    land(f"{scratch}/raw/day=2", "2.ndjson", lines[50:])
    assert len(run()) == 1
    whole = process_ticks(read_ndjson_tree(spark, f"{scratch}/raw", schema=RAW_TICK_SCHEMA), ingest_ts="2025-01-01 00:00:00", tie_break=["venue"])
    stored = state.read()
    assert sorted(map(tuple, stored.select("sequence_id", "venue", "bid", "ask").collect())) == sorted(map(tuple, whole.select("sequence_id", "venue", "bid", "ask").collect()))
    quotes = store.valid(stored.schema)
    assert quotes.count() == sum('"ask":"0.5"' not in x for x in lines)
    assert spark.read.parquet(store.malformed).count() == 1
    state.drop()


# --- latest rows ---------------------------------------------------------

STATE = "k bigint, t bigint, u bigint, v string"


def test_state_is_not_exchanged(spark):
    state = LatestState(spark, f"s_{uuid.uuid4().hex}", "k", ["t", "u"], buckets=8)
    rows = spark.range(4000).selectExpr("id % 500 AS k", "id AS t", "id AS u", "'x' AS v")
    state.merge(rows)
    batch = spark.createDataFrame([(3, 10**6, 1, "new"), (9999, 1, 1, "new")], STATE)
    plan = plan_of(state.merged(batch))
    stored, new = plan.split("FullOuter")[1].split("\n", 1)[1], plan.count("Exchange hashpartitioning")
    scan = next(line for line in stored.splitlines() if "FileScan parquet" in line)
    assert "Bucketed: true" in scan
    # the only exchanges are the batch's: its window, and its way to the buckets
    above = plan[: plan.index("FileScan parquet")]
    assert "Exchange" not in above and new <= 2
    state.merge(batch)
    got = {r["k"]: r["v"] for r in state.read().collect()}
    assert len(got) == 501 and got[3] == got[9999] == "new" and sum(v == "new" for v in got.values()) == 2
    state.drop()
    assert not state.exists()


def test_batches_in_any_order_give_the_latest(spark):
    rng = random.Random(1)
    values = [None, 1, 2, 3]
    rows = list({(rng.choice([None, *range(12)]), rng.choice(values), rng.choice(values)) for _ in range(200)})
    rows = [(k, t, u, f"{t}/{u}") for k, t, u in rows]
    rng.shuffle(rows)
    state = LatestState(spark, f"s_{uuid.uuid4().hex}", "k", ["t", "u"], buckets=4)
    for a in range(0, len(rows), 40):
        state.merge(spark.createDataFrame(rows[a : a + 40], STATE))
    before = sorted(map(tuple, state.read().collect()))
    state.merge(spark.createDataFrame(rows[:40], STATE))  # again
    state.merge(spark.createDataFrame([], STATE))
    assert sorted(map(tuple, state.read().collect())) == before
    whole = latest_per_key(spark.createDataFrame(rows, STATE), ["k"], ["t", "u"], null_keys="drop")
    assert before == sorted(map(tuple, whole.collect())) and len(before) == 12
    with pytest.raises(ValueError):
        state.merge(spark.createDataFrame([(1, 2)], "k bigint, t bigint"))
    state.drop()


# --- partial sums --------------------------------------------------------

DAILY = "security_id string, trade_date_str string, quantity bigint, price double"


def test_half_loads_equal_a_whole_load(spark, scratch):
    rng = random.Random(2)
    rows = [(rng.choice(["A", "B", None]), rng.choice([None, *(f"2025-01-{d:02d}" for d in range(1, 10))]), rng.choice([None, 5, 7]), rng.choice([None, 0.5, 1.25])) for _ in range(300)]
    daily = lambda part: spark.createDataFrame(part, DAILY)
    whole, halves = DailyState(spark, f"{scratch}/whole"), DailyState(spark, f"{scratch}/halves")
    whole.merge(daily(rows), "all")
    halves.merge(daily(rows[:150]), "first")
    halves.merge(daily(rows[150:]), "second")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, halves.read(9).collect())) == sorted(map(key, whole.read(9).collect()))
    halves.merge(daily(rows[150:]), "second")  # a repeat after all days were replaced
    assert sorted(map(key, halves.read(9).collect())) == sorted(map(key, whole.read(9).collect()))
    halves.merge(daily([]), "none")
    assert halves.read().count() == whole.read().count()


def test_a_merge_that_broke_off_halfway_counts_nothing_twice(spark, scratch):
    state = DailyState(spark, f"{scratch}/s")
    frame = lambda rows: spark.createDataFrame(rows, DAILY)
    state.merge(frame([("A", "d1", 1, 1.0), ("A", "d2", 1, 1.0)]), "b1")
    state.merge(frame([("A", "d1", 5, 3.0)]), "b2")  # the part of b2 that had been replaced
    state.merge(frame([("A", "d1", 5, 3.0), ("A", "d2", 7, 3.0)]), "b2")  # the repeat
    assert sorted(map(tuple, state.read().collect())) == [("A", "d1", 6, 2.0), ("A", "d2", 8, 2.0)]


def test_only_touched_days_are_read_and_replaced(spark, scratch):
    import os

    state = DailyState(spark, f"{scratch}/s")
    state.merge(spark.createDataFrame([("A", f"2025-01-0{d}", 1, 1.0) for d in range(1, 8)], DAILY), "b1")
    files = lambda: {f: os.listdir(f"{scratch}/s/{f}") for f in os.listdir(f"{scratch}/s") if "=" in f}
    before = files()
    batch = spark.createDataFrame([("A", "2025-01-03", 1, 1.0)], DAILY)
    touched = state.touched(state._partial(batch, "b2"))
    assert "PartitionFilters: [isnotnull(trade_date_str" in plan_of(touched) or "PartitionFilters: [(trade_date_str" in plan_of(touched)
    state.merge(batch, "b2")
    assert [f for f in files() if files()[f] != before[f]] == ["trade_date_str=2025-01-03"]
