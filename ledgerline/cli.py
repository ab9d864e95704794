"""Command line for the four jobs (``python -m ledgerline <job> ...`` or spark-submit).

Database credentials are read from a Java-style properties file given on
the command line (``user=...``, ``password=...``, ``driver=...``); nothing
secret lives in code or arguments.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import fields, is_dataclass

from pyspark.sql import SparkSession


def read_properties(path: str | None) -> dict[str, str]:
    """``key=value`` lines; ``#`` comments and blank lines are skipped."""
    props: dict[str, str] = {}
    if not path:
        return props
    with open(path) as fh:
        for line in fh:
            line = line.strip()
            if not line or line.startswith("#") or "=" not in line:
                continue
            key, value = line.split("=", 1)
            props[key.strip()] = value.strip()
    return props


def _jdbc(args) -> dict | None:
    if not getattr(args, "jdbc_url", None):
        return None
    if not args.jdbc_table:
        raise SystemExit("--jdbc-url needs --jdbc-table")
    return {"url": args.jdbc_url, "table": args.jdbc_table, "properties": read_properties(args.jdbc_properties)}


def _add_jdbc(p: argparse.ArgumentParser, required: bool = False) -> None:
    p.add_argument("--jdbc-url", required=required)
    p.add_argument("--jdbc-table", help="target table (required with --jdbc-url)")
    p.add_argument("--jdbc-properties", help="properties file with user, password, driver")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerline")
    parser.add_argument("--master", default=None, help="leave unset under spark-submit")
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    parser.add_argument("--input-gb", type=float, default=None,
                        help="expected input size; sizes shuffle partitions and scan splits")
    sub = parser.add_subparsers(dest="job", required=True)

    p = sub.add_parser("contacts", help="CSV -> full name + digit filter -> JDBC table")
    p.add_argument("--csv", required=True)
    p.add_argument("--pattern", default=r"\d+")
    _add_jdbc(p, required=True)

    p = sub.add_parser("joins", help="plain vs bucketed customer-transaction join")
    p.add_argument("--customers", required=True)
    p.add_argument("--transactions", required=True)
    p.add_argument("--buckets", type=int, default=None, help="default: from the input size")
    p.add_argument("--database", default="ledgerline_demo")
    p.add_argument("--base-path", default=None, help="table folder (default: the shared folder)")
    p.add_argument("--min-share", type=float, default=None,
                   help="join customers holding this share of transactions apart (salted)")

    p = sub.add_parser("orders", help="daily volume and average price per security")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--generate", type=int, metavar="N", help="N synthetic orders")
    src.add_argument("--json", help="multi-line JSON orders")
    p.add_argument("--schema", default=None, help="DDL of the JSON fields (default: text ids, doubles, timestamp)")
    p.add_argument("--permissive", action="store_true", help="JSON values that a type cannot hold become null")
    p.add_argument("--partitions", type=int, default=None, help="lay orders out over so many partitions")
    p.add_argument("--layout", choices=("auto", "key", "even"), default="auto",
                   help="cache layout: by security (key), even, or key unless a security is hot (auto)")
    p.add_argument("--preview", type=int, default=20)
    p.add_argument("--parquet", default=None, help="day-partitioned output path")
    _add_jdbc(p)

    p = sub.add_parser("ticks", help="NDJSON landing tree -> partitioned Parquet")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--export", default=None, help="bounded-file export (sibling path)")
    p.add_argument("--quarantine", default=None)
    p.add_argument("--permissive", action="store_true", help="malformed values become null")
    p.add_argument("--glob", default="*.ndjson")
    p.add_argument("--time-zone", default=None, help="zone of the output's date folders (default: session)")
    p.add_argument("--tie-break", action="append", default=[], metavar="COLUMN",
                   help="column that decides between equal receive times, largest first (repeatable)")
    p.add_argument("--null-keys", choices=("collapse", "keep", "drop"), default="collapse")
    return parser


def _jsonable(obj):
    if is_dataclass(obj) and not isinstance(obj, type):
        return {f.name: _jsonable(getattr(obj, f.name)) for f in fields(obj) if f.name != "daily"}
    if hasattr(obj, "asDict"):          # a Row is a tuple: handle it before sequences
        return {k: _jsonable(v) for k, v in obj.asDict().items()}
    if isinstance(obj, dict):
        return {k: _jsonable(v) for k, v in obj.items()}
    if isinstance(obj, (list, tuple)):
        return [_jsonable(v) for v in obj]
    if isinstance(obj, (str, int, float, bool)) or obj is None:
        return obj
    return str(obj)


def run(args, spark: SparkSession) -> dict:
    from ledgerline.plans import contacts, customer_transactions, orders, ticks

    if args.job == "contacts":
        jdbc = _jdbc(args)
        contacts.run_contacts(spark, args.csv, jdbc["url"], jdbc["table"], jdbc["properties"], args.pattern)
        return {"job": "contacts", "table": jdbc["table"]}
    if args.job == "joins":
        res = customer_transactions.compare_join_strategies(
            spark,
            customer_transactions.read_customers(spark, args.customers),
            customer_transactions.read_transactions(spark, args.transactions),
            args.database, args.buckets, args.base_path, args.min_share,
        )
        return {"job": "joins", **_jsonable(res)}
    if args.job == "orders":
        if args.generate is not None:
            res = orders.run_generated_orders(
                spark, args.generate, args.partitions or 50, preview_rows=args.preview,
                parquet_path=args.parquet, jdbc=_jdbc(args), layout=args.layout)
        else:
            res = orders.run_orders_json(
                spark, args.json, args.preview, args.parquet, _jdbc(args),
                schema=args.schema or orders.ORDER_SCHEMA, strict=not args.permissive,
                partitions=args.partitions, layout=args.layout)
        return {"job": "orders", **_jsonable(res)}
    res = ticks.run_ticks(
        spark, args.raw, args.out, export_path=args.export, quarantine_path=args.quarantine,
        strict=not args.permissive, file_glob=args.glob, time_zone=args.time_zone,
        tie_break=args.tie_break, null_keys=args.null_keys)
    return {"job": "ticks", **_jsonable(res)}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = build_parser().parse_args(argv)
    own = spark is None
    if own:
        from ledgerline.session import build_session

        input_bytes = int(args.input_gb * (1 << 30)) if args.input_gb else None
        spark = build_session(args.master, app_name=f"ledgerline-{args.job}",
                              shuffle_partitions=args.shuffle_partitions, input_bytes=input_bytes)
    try:
        result = run(args, spark)
        print(json.dumps(result, default=str))
        return result
    finally:
        if own:
            spark.stop()
