"""Rule ensemble: rules of printed trees, statistics, held-out accuracy, and edge cases."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.rule_ensemble import Rule, STATISTICS, classified, fit_ensemble, scored, statistics, tree_rules
from tests.conftest import SF01
from tests.llm.helpers import make_docs, prose

TREE = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=3
  If (feature 0 <= 2.5)
   If (feature 2 > 1.0E-4)
    Predict: 0.0
   Else (feature 2 <= 1.0E-4)
    Predict: 1.0
  Else (feature 0 > 2.5)
   If (feature 0 <= 4.0)
    Predict: 1.0
   Else (feature 0 > 4.0)
    Predict: 0.0
"""
INF = float("inf")


def test_rules_of_a_tree():
    got = tree_rules(TREE, ("a", "b", "c"))
    assert got == [
        Rule((("a", -INF, 2.5),)), Rule((("a", -INF, 2.5), ("c", 1e-4, INF))), Rule((("a", -INF, 2.5), ("c", -INF, 1e-4))),
        Rule((("a", 2.5, INF),)), Rule((("a", 2.5, 4.0),)), Rule((("a", 4.0, INF),)),
    ]


def test_statistics(spark):
    text = "Ab ab, ab### 12\n \nsame line\nsame line"
    row = spark.createDataFrame([(text,), (None,), ("",)], "text string").select(statistics(F.col("text")).alias("s")).select("s.*")
    one, none, blank = row.collect()
    assert tuple(none) == tuple(blank) == (0.0,) * len(STATISTICS)
    solid = len("Abab,ab###12samelinesameline")
    expected = {"words": 8, "chars": len(text), "mean_word": solid / 8, "longest_word": 5, "distinct_share": 6 / 8, "again_share": 0, "short_share": 3 / 8,
                "symbol_share": 3 / solid, "digit_share": 2 / solid, "capital_share": 1 / solid, "stop_share": 1 / 8, "other_share": 0, "lines": 3, "mean_line": solid / 3, "again_lines": 1 / 3}
    assert {k: one[k] for k in expected} == pytest.approx(expected) and set(expected) == set(STATISTICS)


def table(seed=4, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(rng, rng.randint(30, 200))
        if bad:
            text = " ".join(w + rng.choice(["", "###", "$$"]) for w in text.split()) if i % 8 else "again " * rng.randint(20, 90)
        rows.append((i, text))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rows, labels = table()
    edges = [(1000, None), (1001, ""), (None, "null id " * 20), (1002, "x" * 200_000), (3, rows[3][1]), (3, rows[3][1])]
    known = spark.createDataFrame([*labels, (5000, 1, 0), (None, 1, 0), (7, None, 0), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs = make_docs(spark, rows + edges).withColumns({"score": F.lit(9.0), "label": F.lit(1), "words": F.lit("w"), "id": F.lit(0)})
    out = classified(docs, known, train_docs=250)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == len(rows) + len(edges)
    got = out.collect()
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    truth = {i: q for i, q, _ in labels}
    judged = [r["predicted"] == truth[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(judged) > 100 and sum(judged) >= 0.97 * len(judged)
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    # held-out labels are never read: flipping them changes nothing
    flipped = known.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = classified(docs.repartition(5), flipped, train_docs=250)
    key = lambda r: (str(r["doc_id"]), r["score"])
    assert sorted(map(key, again.collect())) == sorted(map(key, got))


def test_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = classified(docs, labels).join(labels, "doc_id").where("held_out").groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right"))
    assert all(r["right"] >= 0.95 for r in out.collect())


def test_no_labels_and_no_rows(spark):
    schema = "doc_id bigint, quality int, toxic int"
    docs = make_docs(spark, [(i, "some words here") for i in range(9)])
    none = spark.createDataFrame([], schema)
    assert {r["score"] for r in classified(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(9)], schema)
    assert not fit_ensemble(docs, ones).rules and all(r["predicted"] == 1 for r in classified(docs, ones).collect())
    assert classified(make_docs(spark, []), none).count() == 0
    with pytest.raises(ValueError):
        scored(docs.withColumn("score", F.lit(1)), fit_ensemble(docs, none))
