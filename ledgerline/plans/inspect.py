"""Plan inspection for tests and tuning: the text ``explain()`` prints."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    """The physical plan tree (``explain("simple")``)."""
    return plan_text(df, "simple")


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of operator ``name`` (e.g. ``"Exchange"``) in the physical plan tree."""
    pattern = re.compile(rf"(^|[\s+\-:*]){re.escape(name)}\b")
    return sum(1 for line in physical_plan(df).splitlines() if pattern.search(line))


_SCAN = re.compile(r"^\((\d+)\) Scan (\w+)")
_FIELD = re.compile(r"^(PushedFilters|PartitionFilters|ReadSchema|DataFilters): (.*)$")


def scan_summary(df: DataFrame) -> list[dict[str, str]]:
    """One entry per file scan in ``explain("formatted")``: ``format`` plus the
    ``ReadSchema``, ``PushedFilters`` and ``PartitionFilters`` lines -- what
    reaches the reader (column pruning, predicate and partition pushdown)."""
    scans: list[dict[str, str]] = []
    current: dict[str, str] | None = None
    for line in plan_text(df, "formatted").splitlines():
        head = _SCAN.match(line)
        if head:
            current = {"node": head.group(1), "format": head.group(2)}
            scans.append(current)
            continue
        if current is not None:
            field = _FIELD.match(line)
            if field:
                current[field.group(1)] = field.group(2)
            elif not line.strip():
                current = None
    return scans


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (file sizes for a plain scan); nothing is read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
