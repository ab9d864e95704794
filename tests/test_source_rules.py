"""Source-level guards for the scale rules the library commits to."""

import os
import pathlib
import re
import shutil
import subprocess
import sys

PACKAGE = pathlib.Path(__file__).resolve().parent.parent / "ledgerline"

# API uses that do not survive executor loss, funnel data through one task or the
# driver, or leave the DataFrame planner
FORBIDDEN = {
    r"\.localCheckpoint\(": "local checkpoints are lost with their executor",
    r"\.crossJoin\(": "no cross joins",
    r"\.rdd\b": "stay on DataFrames",
    r"\.coalesce\(\s*1\s*\)": "no single-task output",
    r"\.toPandas\(": "no whole results on the driver",
    r"tempfile\.(mkdtemp|gettempdir)": "machine-local folders only where no checkpoint folder is set",
}

# the only driver-side collects, each bounded (see README, D6)
ALLOWED_COLLECTS = {
    ("aggregate.py", "rows = df.limit(max_rows + 1).collect()"),
    ("orders.py", "preview = daily_preview(daily, preview_rows).collect() if preview_rows else []"),
}


def _sources():
    return [(p, p.read_text()) for p in PACKAGE.rglob("*.py") if p.parent.name != "llm"]  # tests/llm has its own rules


def test_no_forbidden_api():
    for path, text in _sources():
        for pattern, why in FORBIDDEN.items():
            hits = [line for line in text.splitlines() if re.search(pattern, line)]
            if path.name == "session.py" and pattern.startswith("tempfile"):
                assert len(hits) == 1 and "mkdtemp" in hits[0]      # the unset-checkpoint fallback
                continue
            assert not hits, f"{path.name}: {why}: {hits}"


def test_driver_collects_are_the_bounded_ones():
    found = set()
    for path, text in _sources():
        for line in text.splitlines():
            if ".collect()" in line and not line.strip().startswith("#"):
                found.add((path.name, line.strip()))
    assert found == ALLOWED_COLLECTS


def test_works_without_the_optional_folders(tmp_path):
    """A copy of the tree without the training-data folders imports and registers the other queries."""
    root = PACKAGE.parent
    shutil.copytree(PACKAGE, tmp_path / "ledgerline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()) and len(q) > 30"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})
