"""Splittable JSON documents: the rows of the one-task reader, whatever the splits."""

import json
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.plans.orders import orders_daily, read_orders_json, rejected_json_values
from ledgerline.sources.files import read_json_documents
from ledgerline.sources.json_arrays import json_records, read_json_array

SCHEMA = "a bigint, s string, x double, o struct<k: string, v: array<bigint>>, l array<struct<k: string>>"
NASTY = ["}", "{", "]", "[", '"', "\\", "\\\\", '\\"', '"}', "},{", '\\"},{\\"a\\":1', "\n", "é中}😀{", "\t", "/", "", " ", "}" * 40, '"' * 9, "\\" * 8 + "}"]


@pytest.fixture()
def small_splits(spark):
    """Files are cut every few bytes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", str(n))

    yield cut
    for k, v in kept.items():
        spark.conf.set(k, v)


def record(rng):
    text = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 4)))
    r = {"a": rng.randint(-9, 10**12), "s": text(), "x": rng.choice([1.5, 2, -3e-7, None]), "o": {"k": text(), "v": [1, 2]}, "l": [{"k": text()} for _ in range(rng.randint(0, 3))]}
    return {k: v for k, v in r.items() if rng.random() < 0.85}


def put(folder, name, text, newline=""):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline=newline) as f:
        f.write(text)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("split", [29, 400])
def test_equals_one_task_reader(spark, scratch, small_splits, split):
    rng = random.Random(split)
    records = [record(rng) for _ in range(24)]
    put(scratch, "pretty.json", json.dumps(records[:8], indent=2))
    put(scratch, "line.json", json.dumps(records[8:18], ensure_ascii=False))
    put(scratch, "object.json", json.dumps(records[18], indent=1))
    put(scratch, "one.json", " \r\n " + json.dumps(records[19:20]) + " \n")
    put(scratch, "wide.json", "[" + ("," + " " * 50).join(json.dumps(r) for r in records[20:]) + "\n\n]\n")
    put(scratch, "empty.json", "[ ]")
    put(scratch, "none.json", "")
    expected = rows(read_json_documents(spark, scratch, schema=SCHEMA))
    assert len(expected) == 24
    small_splits(split)
    got = read_json_array(spark, scratch, SCHEMA)
    assert got.schema == read_json_documents(spark, scratch, schema=SCHEMA).schema
    assert rows(got) == expected
    assert split > 100 or json_records(spark, scratch).rdd.getNumPartitions() > 50


def test_without_broadcast(spark, scratch, small_splits):
    rng = random.Random(3)
    records = [record(rng) for _ in range(16)]
    put(scratch, "a.json", json.dumps(records[:8], indent=2))
    put(scratch, "b.json", json.dumps(records[8:]))
    small_splits(50)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = json_records(spark, scratch, max_broadcast_splits=1)
        assert "BroadcastHashJoin" not in texts._jdf.queryExecution().executedPlan().toString()
        assert sorted(json.dumps(json.loads(r["value"])) for r in texts.collect()) == sorted(map(json.dumps, records))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.dictionaries(st.text('ab"\\{}[]é', max_size=3), st.recursive(st.text('{}[]"\\,: é', max_size=6) | st.integers(-5, 5) | st.none(), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("k}", max_size=2), x, max_size=2), max_leaves=5), max_size=4), max_size=5), indent=st.sampled_from([None, 1]), split=st.integers(12, 90))
def test_any_records(spark, tmp_path_factory, values, indent, split):
    folder = str(tmp_path_factory.mktemp("any"))
    put(folder, "f.json", json.dumps(values, indent=indent, ensure_ascii=False))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", str(split))
    try:
        got = [json.loads(r["value"]) for r in json_records(spark, folder).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, values))


@pytest.mark.parametrize("split", [9, 10_000])
def test_malformed_documents_are_seen(spark, scratch, small_splits, split):
    """What is no record, or cut off, is a row of nulls with its text; the rest of the file survives."""
    small_splits(split)
    schema, options = "a bigint, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}
    cases = {
        "cut": ('[{"a": 1}, {"a": 2}, {"a": 3', [1, 2, None]),
        "cut_after": ('[{"a": 1}, {"a": 2}', [1, 2, None]),
        "bare": ('[{"a": 1}, 7, {"a": 2}]', [1, None]),
        "bad": ('[{"a": 1}, {"a" 2}, {"a": 3}]', [1, None, 3]),
        "several": ('{"a": 1}\n{"a": 2} {"a": 3}', [1, 2, 3]),
        "bom": ('﻿[{"a": 1}]', [1]),
        "tail": ('[{"a": 1}] x', [1, None]),
    }
    for name, (text, expected) in cases.items():
        put(f"{scratch}/{name}", "f.json", text)
        got = read_json_array(spark, f"{scratch}/{name}", schema, json_options=options).collect()
        assert sorted((r["a"] for r in got), key=str) == sorted(expected, key=str), name
        assert all((r["a"] is None) == (r["_corrupt_record"] is not None) for r in got), name


def test_compressed_files(spark, scratch, small_splits):
    import gzip

    small_splits(40)
    for name, text in (("a", json.dumps([{"a": i, "s": "}"} for i in range(20)])), ("b", json.dumps({"a": 20}))):
        with gzip.open(f"{scratch}/{name}.json.gz", "wt") as f:
            f.write(text)
    assert sorted(r["a"] for r in read_json_array(spark, scratch, "a bigint").collect()) == list(range(21))


def test_orders_in_many_splits(spark, scratch, small_splits):
    orders = [{"security_id": f"S{i % 7}", "price": 1.5 * i, "quantity": i if i % 2 else f"{i}.0", "timestamp": f"2025-01-0{1 + i % 3}T10:00:00Z"} for i in range(60)]
    put(scratch, "f.json", json.dumps(orders, indent=1))
    whole = rows(orders_daily(read_orders_json(spark, scratch), round_digits=6))
    small_splits(300)
    assert rows(orders_daily(read_orders_json(spark, scratch), round_digits=6)) == whole and len(whole) == 21
    assert rejected_json_values(spark, scratch).first().asDict() == {"security_id": 0, "price": 0, "quantity": 0, "timestamp": 0}


def test_no_text_schema_reaches_the_file_reader(spark, scratch):
    """Numbers are parsed from the text in memory, not by positioned reads of the file."""
    put(scratch, "f.json", json.dumps([{"security_id": 1, "price": 2.5, "quantity": 3, "timestamp": "2025-01-01"}]))
    plan = read_orders_json(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    assert "Scan json" not in plan and "FileScan json" not in plan and "FileScan text" in plan
