"""Write the physical plans of the headline queries as Markdown (``PLANS.md``).

    python tests/plan_report.py [/root/testdata/sf0.01] > PLANS.md

Automatic broadcast is switched off so the joins show the plans they get
when both sides are large; a dimension join still broadcasts behind its
size check.  Only the operator tree is kept (no file paths or ids).
"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HEADLINE = {
    "order_daily_agg": "daily volume and average price: partial aggregate, one exchange, final aggregate",
    "order_daily_agg_topk": "top-20 preview: per-task top-n merged, no full sort",
    "layout_agg": "orders laid out by security first: the aggregate reuses it (one exchange)",
    "tick_latest": "latest quote per sequence: partial top-1 before the exchange",
    "join_inner": "plain join of customers and transactions",
    "join_bucketed": "join over co-bucketed tables: no exchange",
    "join_bucketed_skew": "co-bucketed join with hot customers joined apart (salted)",
    "join_skew": "salted shuffle join for hot customers",
    "dimension_join": "size-checked broadcast of a small dimension",
    "key_skew": "rows and share per key: one aggregate, total as a scalar subquery",
    "rt_parquet_prune": "day-partitioned Parquet read back with a day range: partition filters",
}

_NOISE = [
    (re.compile(r"#\d+L?"), ""),
    (re.compile(r", \[plan_id=\d+\]"), ""),
    (re.compile(r"Location: [^\[,]*\[[^,]*"), "Location: …"),
    (re.compile(r"INSET (?:[-\w.]+, )*(?:[-\w.]+|\.\.\. \d+ more fields)"), "INSET <hot keys>"),
    (re.compile(r"file:[^\s,\]]+"), "…"),
]


_SCAN = re.compile(r"^(?P<indent>.*?)(?P<head>FileScan \w+ [^\[]*\[[^\]]*\])")
_SCAN_FIELDS = ("PartitionFilters", "PushedFilters")


def _scan_line(line: str) -> str:
    """``FileScan <format> [columns]`` plus what was pushed into it."""
    m = _SCAN.match(line)
    if not m:
        return line
    parts = [m.group("indent") + m.group("head")]
    for field in _SCAN_FIELDS:
        found = re.search(rf"{field}: (\[[^\]]*\])", line)
        if found and found.group(1) != "[]":
            parts.append(f"{field}: {found.group(1)}")
    bucketed = re.search(r"SelectedBucketsCount: [^,]*", line)
    if "Bucketed: true" in line:
        parts.append("Bucketed: true" + (f", {bucketed.group(0)}" if bucketed else ""))
    return ", ".join(parts)


def _tree(plan: str) -> str:
    lines = []
    for line in plan.splitlines():
        if line.startswith("== Physical Plan"):
            continue
        for pattern, repl in _NOISE:
            line = pattern.sub(repl, line)
        line = _scan_line(line)
        if len(line) > 240:
            line = line[:237] + "..."
        lines.append(line)
    return "\n".join(lines).strip()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from ledgerline.plans.inspect import physical_plan
    from ledgerline.session import build_session
    import __spark_entry__ as entry

    spark = build_session("local[8]", shuffle_partitions=8,
                          conf={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                # print whole filter lists and field lists (shortened below)
                                "spark.sql.maxMetadataStringLength": "10000",
                                "spark.sql.debug.maxToStringFields": "100000"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = entry.queries()
    print("# PLANS — physical plans of the headline queries\n")
    print(f"Generated by `python tests/plan_report.py {sf_dir}` (initial adaptive plans, before execution;")
    print("automatic broadcast off, so joins show their large-input form). Ids and paths are elided.\n")
    for name, what in HEADLINE.items():
        plan = _tree(physical_plan(queries[name](spark, sf_dir)))
        print(f"## `{name}` — {what}\n\n```\n{plan}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
