"""The pipeline's stages on a small corpus, and source rules of the folder."""

import pathlib
import re

import corpus_pipeline
import __spark_entry__ as entry
from tests.llm.helpers import corpus, prose

ROOT = pathlib.Path(corpus_pipeline.__file__).parent


def test_stages(spark, tmp_path):
    import random

    rng = random.Random(12)
    passage = prose(rng, 80, 4000)
    rows = corpus(12) + [(900 + i, f"{prose(rng, 120, 4000)} {passage}") for i in range(4)] + [(950, "### | *** " * 40), (960, prose(rng, 60, 4000) + ' password = "abcdefgh1234"')]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf = str(tmp_path)
    at, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{sf}/{name}")
        at = spark.read.parquet(f"{sf}/{name}")
        seen[name] = at.collect()
    ids = {name: [r["doc_id"] for r in seen[name]] for name in seen}
    assert 950 not in ids["quality_rules"] and 500 not in ids["quality_rules"] and {900, 901, 902, 903, 960} <= {*ids["quality_rules"]}
    assert 407 not in ids["ngram_jaccard"] and len(ids["ngram_jaccard"]) < len(ids["quality_rules"])
    texts = {r["doc_id"]: r["text"] for r in seen["substring_dedup"]}
    assert passage in texts[900] and all(passage not in texts[i] for i in (901, 902, 903))
    assert all(r["n_chars"] == len(r["text"]) for r in seen["secret_scan"])
    masked = {r["doc_id"]: r["text"] for r in seen["secret_scan"]}
    assert masked[960].endswith('[SECRET]"')
    assert {*ids["best_fit_packing"]} == {*ids["secret_scan"]}
    assert corpus_pipeline.run(spark, sf).count() == len(seen["best_fit_packing"])


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


def test_sources():
    files = [*(ROOT / "ledgerline/llm").glob("*.py"), ROOT / "corpus_pipeline.py"]
    assert len(files) > 10
    for path in files:
        text = path.read_text()
        for pattern in (r"localCheckpoint", r"crossJoin", r"\.rdd\b", r"toPandas", r"coalesce\(1\)", "tempfile", "except ImportError"):
            assert not re.search(pattern, text), (path.name, pattern)
    for name in ("quality", "secrets", "surrogates"):  # DataFrame functions only
        text = (ROOT / f"ledgerline/llm/{name}.py").read_text()
        assert not re.search("mapIn|applyIn|udf|pyarrow|pandas", text), name


def test_nothing_else_imports_the_folder():
    for path in (ROOT / "ledgerline").rglob("*.py"):
        if path.parent.name != "llm":
            assert not re.search(r"ledgerline\.llm|from \.+llm|import llm", path.read_text()), path
