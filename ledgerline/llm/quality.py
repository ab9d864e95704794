"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Every word and every pair of neighbouring words falls into one of ``buckets``
buckets.  Bucket counts over all documents give the raw-corpus multinomial,
those over all trusted documents the target multinomial.  A
document scores the mean of ``ln p_target - ln p_raw`` over its own n-grams
(so length does not matter) and is kept from ``threshold`` on.  Bucket weights
are whole micro-nats, so sums are exact and the verdict of a document never
depends on how the data are partitioned.

All of it is DataFrame functions.  The corpus pass shuffles at most a count
per bucket and task; scoring is narrow, with the weights as a scalar subquery
of ``buckets`` numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import free_names, let, words

BUCKETS = 1 << 14
#: Mean log ratio, in micro-nats, from which on a document is kept.
THRESHOLD = -100_000
#: Grams of the raw corpus that the target is blended with: a small trusted set says little about
#: words that it does not hold, a large one much.
PRIOR = 1 << 17
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def word_hashes(ws: Column) -> Column:
    """64-bit hashes of a word array."""
    return F.transform(ws, lambda x: F.xxhash64(x))


def gram_buckets(h: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and all pairs of neighbours, from the words' hashes."""
    pairs = F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), F.slice(h, 2, F.size(h)), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)))
    return F.concat(F.transform(h, lambda x: F.pmod(x, F.lit(buckets))), pairs)


def repeated_words(h: Column, width: int = 5) -> Column:
    """Words in windows of ``width`` words found twice or more in the text, the first included.

    Windows are compared by 64-bit hashes of their words' hashes.
    """

    def covered(g: Column) -> Column:
        def windows(s: Column) -> Column:
            again = F.filter(s, lambda e, j: F.get(s, j - 1)["x"].eqNullSafe(e["x"]) | F.get(s, j + 1)["x"].eqNullSafe(e["x"]))
            return let(
                F.sort_array(F.transform(again, lambda e: e["i"])),
                lambda p: F.aggregate(
                    F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(width)), F.lit(width))),
                    F.lit(0).cast("bigint"),
                    lambda acc, x: acc + x,
                ),
            )

        slow = let(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), windows)
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("bigint")).otherwise(slow)

    last = F.greatest(F.size(h) - (width - 1), F.lit(0))
    grams = F.transform(F.slice(h, 1, last), lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, width))))
    return F.when(F.size(h) < width, F.lit(0).cast("bigint")).otherwise(let(grams, covered))


def bucket_weights(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """One row, ``weights``: for each bucket ``ln p_target - ln p_raw`` in micro-nats."""
    trusted = labels.where("quality = 1 and toxic = 0").where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id")).distinct()
    # texts, not their hashes, meet the trusted ids, as texts are the smaller exchange; ids grow with the corpus, so none are
    # broadcast at any size, and what is exchanged grows as the texts do
    grams = (
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
        .join(trusted.withColumn("__target", F.lit(1)).hint("merge"), "__id", "left")
        .select("__target", F.explode(gram_buckets(word_hashes(words(F.col("__text"))), buckets)).alias("b"))
    )
    counts = grams.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count("__target").alias("target"))
    every = docs.sparkSession.range(0, buckets, 1, 1).select(F.col("id").alias("b"))
    full = every.join(counts, "b", "left").select("b", *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("raw", "target")))
    one = full.agg(F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("c"), F.sum("raw").alias("r"), F.sum("target").alias("t"))
    raw = lambda e: (e["raw"] + F.lit(1.0)) / (F.col("r") + F.lit(float(buckets)))
    target = lambda e: (e["target"] + F.lit(float(PRIOR)) * raw(e)) / (F.col("t") + F.lit(float(PRIOR)))
    return one.select(F.transform("c", lambda e: F.round(F.log(target(e) / raw(e)) * 1e6).cast("bigint")).alias("weights"))


def with_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    buckets: int = BUCKETS,
    name: str = "__quality",
) -> DataFrame:
    """``docs`` and a struct column ``name`` of :data:`MEASURES`.

    ``score`` is the sum of the weights of the document's n-grams; the mean
    is compared by ``score >= threshold * n-grams``, in whole numbers.  Null
    and empty texts have no words and fail the base rules.  Null and repeated
    ids are measured row by row (a repeated trusted id counts each time in
    the target); an empty table gives an empty result; without trusted labels
    the target is uniform.
    """
    if name in docs.columns:
        raise ValueError(f"{name} is taken")
    weights = bucket_weights(docs, labels, id_col, text_col, buckets).scalar()
    (own,) = free_names(docs, "__weights")
    judged = docs.withColumn(own, weights).withColumn(name, _measures(F.col(f"`{text_col}`"), F.col(own), threshold, buckets))
    return judged.drop(own)


def _measures(text: Column, weights: Column, threshold: int, buckets: int) -> Column:
    """The struct of :data:`MEASURES`: one expression that binds words, hashes and weights once each.

    A filter on one of its fields may be pushed down as a copy of the whole
    expression, which stays as cheap as the original.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counted(w: Column, h: Column, m: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
            repeated_words(h).alias("n_repeat_words"),
            F.aggregate(gram_buckets(h, buckets), F.lit(0).cast("bigint"), lambda acc, b: acc + F.get(m, b.cast("int"))).alias("score"),
        )

    def verdict(r: Column) -> Column:
        failed = (r["n_words"] < 10) | (100 * r["n_repeat_words"] > 20 * r["n_words"])
        kept = ~failed & (r["score"] >= threshold * (2 * r["n_words"] - 1))
        return F.struct(*(r[c].alias(c) for c in MEASURES[:5]), failed.alias("base_failed"), r["score"].alias("score"), kept.alias("kept"))

    return let(words(text), lambda w: let(word_hashes(w), lambda h: let(weights, lambda m: let(counted(w, h, m), verdict))))


def quality_filter(docs: DataFrame, labels: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    (name,) = free_names(docs, "__quality")
    return with_quality(docs, labels, **options, name=name).where(F.col(f"{name}.kept")).select(*(F.col(f"`{c}`") for c in docs.columns))
