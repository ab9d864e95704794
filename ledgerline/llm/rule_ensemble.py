"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

*Statistics* of a text are native columns: lengths, shares of kinds of
characters, repetition of words and lines.

*Rules.*  A random forest of shallow trees is fitted on the statistics of
labelled documents.  Every node below a root is a rule: the conjunction of the
comparisons on its path, with comparisons of one statistic merged.

*Weights.*  A logistic regression with an L1 penalty (lasso) over the rules'
truth values keeps few of them.

*Scoring.*  The weighted rules compile into one Spark column expression, so
scoring is a narrow pass without Python.

The fit reads at most ``TRAIN_DOCS`` labelled documents (those first by digest
of the id), so it costs the same for any corpus; scoring covers all rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import let, staged, words

#: Labelled documents that the ensemble is fitted on, at most.
TRAIN_DOCS = 8000
TREES, DEPTH, PENALTY, SEED = 16, 3, 0.002, 12
#: Rules whose weight is below this in size are dropped.
SMALLEST = 1e-4
#: A document is held out of the fit where the digest of its id leaves this remainder.
PARTS, HELD_OUT = 3, 1

#: The statistics, in the order of the fit's vectors.
STATISTICS = (
    "words", "chars", "mean_word", "longest_word", "distinct_share", "again_share", "short_share",
    "symbol_share", "digit_share", "capital_share", "stop_share", "other_share", "lines", "mean_line", "again_lines",
)


def _share(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where there is nothing."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def statistics(text: Column) -> Column:
    """Struct of :data:`STATISTICS` (doubles) of a text; a null one is empty.

    ``again_share``: words equal to the one before; ``other_share``: characters
    that are neither ASCII nor Latin letters; ``again_lines``: lines with a word
    that equal another one.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.trim(x) != "")

    def measured(w: Column, x: Column) -> Column:
        n, chars = F.size(w).cast("double"), F.length(whole).cast("double")
        solid = F.length(F.array_join(w, "")).cast("double")
        of = lambda pattern: F.regexp_count(whole, F.lit(pattern)).cast("double")
        again = F.size(F.filter(w, lambda y, i: (i > 0) & (y == F.get(w, i - 1)))).cast("double")
        longest = F.aggregate(w, F.lit(0), lambda acc, y: F.greatest(acc, F.length(y))).cast("double")
        line_count = F.size(x).cast("double")
        values = {
            "words": n,
            "chars": chars,
            "mean_word": _share(solid, n),
            "longest_word": longest,
            "distinct_share": _share(F.size(F.array_distinct(w)).cast("double"), n),
            "again_share": _share(again, n),
            "short_share": _share(F.size(F.filter(w, lambda y: F.length(y) <= 3)).cast("double"), n),
            "symbol_share": _share(of(r"[#*$%&|<>{}\[\]=_~^\\]"), solid),
            "digit_share": _share(of("[0-9]"), solid),
            "capital_share": _share(of("[A-Z]"), solid),
            "stop_share": _share(of("[.,;:!?]"), n),
            "other_share": _share(of("[^\\x00-\\xFF]"), solid),
            "lines": line_count,
            "mean_line": _share(solid, line_count),
            "again_lines": _share(line_count - F.size(F.array_distinct(x)).cast("double"), line_count),
        }
        return F.struct(*(values[c].alias(c) for c in STATISTICS))

    return let(words(text), lambda w: let(lines, lambda x: measured(w, x)))


@dataclass(frozen=True)
class Rule:
    """Bounds ``low < statistic <= high`` that must all hold."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self, stats: Column) -> Column:
        held = F.lit(True)
        for name, low, high in self.bounds:
            if low > -math.inf:
                held = held & (stats[name] > low)
            if high < math.inf:
                held = held & (stats[name] <= high)
        return held


@dataclass
class RuleEnsemble:
    """Weighted rules; ``score = 1 / (1 + exp(-(intercept + sum of the weights of rules that hold)))``."""

    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self, stats: Column) -> Column:
        """The score as one native expression over a struct of statistics."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


_NODE = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")


def tree_rules(tree_text: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The rules of a tree, one for each node below the root, from its printed form
    (``toDebugString``), where a node's comparison is indented by its depth."""
    rules, path = [], []
    for line in tree_text.splitlines():
        if found := _NODE.match(line):
            indent, _, feature, sign, value = found.groups()
            path = [p for p in path if p[0] < len(indent)]
            path.append((len(indent), names[int(feature)], sign, float(value)))
            bounds: dict[str, tuple[float, float]] = {}
            for _, name, side, at in path:
                low, high = bounds.get(name, (-math.inf, math.inf))
                bounds[name] = (max(low, at), high) if side == ">" else (low, min(high, at))
            rules.append(Rule(tuple((n, *bounds[n]) for n in sorted(bounds))))
    return rules


def held_out(doc_id: Column) -> Column:
    """Whether a document takes no part in the fit; a null id does not count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PARTS == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int) -> DataFrame:
    """Statistics and ``label`` of at most ``limit`` labelled ids that are not held out.

    Repeated ids count each time; an id with both labels is left out, as are null labels and ids.
    """
    known = labels.where(F.col(f"`{label_col}`").isin(0, 1)).groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.min(f"`{label_col}`").alias("label"), F.max(f"`{label_col}`").alias("most"))
    known = known.where(F.col("id").isNotNull() & (F.col("label") == F.col("most")) & ~held_out(F.col("id")))
    order = F.md5(F.col("id").cast("string").cast("binary"))
    sample = known.select("id", F.col("label").cast("double").alias("label"), order.alias("order")).orderBy("order").limit(limit)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(sample), "id")
    stats = rows.select("order", "label", statistics(F.col("text")).alias("s"))
    # dealt and sorted by content, so that the fit sees the same rows in the same places every time
    return stats.select("order", "label", "s.*").repartition(4, "order").sortWithinPartitions("order", *STATISTICS)


def fit_ensemble(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_docs: int = TRAIN_DOCS, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED) -> RuleEnsemble:
    """Fit the ensemble on at most ``train_docs`` labelled documents that are not held out.

    Labels of one kind only, or none, give no rules: every score is then the
    share of label 1, at least a little from 0 and 1 (0.5 without labels).
    """
    rows = staged(training_rows(docs, labels, id_col, text_col, label_col, train_docs), "rule_ensemble")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("ones")).first()
    if total["ones"] in (0, total["n"]):
        return RuleEnsemble(math.log((total["ones"] + 0.5) / (total["n"] - total["ones"] + 0.5)))
    placed = rows.repartition(4, "order").sortWithinPartitions("order", *STATISTICS)
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(placed)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=seed).fit(vectors)
    rules = list(dict.fromkeys(rule for tree in forest.trees for rule in tree_rules(tree.toDebugString)))
    if not rules:
        return RuleEnsemble(math.log((total["ones"] + 0.5) / (total["n"] - total["ones"] + 0.5)))
    stats = F.struct(*STATISTICS)
    truth = placed.select("label", *(rule.column(stats).cast("double").alias(f"r{k}") for k, rule in enumerate(rules)))
    held = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(truth)
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, maxIter=60).fit(held)
    weighted = [(rule, round(float(w), 6)) for rule, w in zip(rules, lasso.coefficients) if abs(w) >= SMALLEST]
    return RuleEnsemble(round(float(lasso.intercept), 6), weighted)


def scored(docs: DataFrame, ensemble: RuleEnsemble, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and the score of every text, 0 to 1, in column ``name``; null and empty texts
    are scored by their statistics, all 0."""
    if name in docs.columns:
        raise ValueError(f"{name} is taken")
    score = let(statistics(F.col(f"`{text_col}`")), lambda s: F.round(ensemble.column(s), 9))
    return docs.withColumn(name, score)


def classified(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options: object) -> DataFrame:
    """``id_col, held_out, score, predicted`` of every row of ``docs``.

    Repeated ids and rows are scored row by row; an empty table gives an empty result.
    """
    ensemble = fit_ensemble(docs, labels, id_col, text_col, label_col, **options)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = scored(rows, ensemble)
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
