"""The registered queries of the training-data operators, with their SQL oracles.

Each query applies one operator, with production parameters, to its whole
table.  Queries that SQL cannot express have no oracle; tests/llm compares
them with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.bpe_stream import encode_decode
from ledgerline.llm.chaining import repeated_passages
from ledgerline.llm.jaccard import similar_groups
from ledgerline.llm.nn_descent import nearest
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.quality import MEASURES, with_quality
from ledgerline.llm.rule_ensemble import classified
from ledgerline.llm.secrets import secret_spans
from ledgerline.llm.spelling import spelling_groups, vocabulary
from ledgerline.llm.suffix_dedup import dedup_substrings
from ledgerline.llm.surrogates import pseudonymize
from ledgerline.llm.token_counts import token_counts
from ledgerline.llm.vector_codes import compressed
from ledgerline.sources.tables import read_test_table

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_test_table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.pmod("vec_id", F.lit(20)) == 0, k=20)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the contract removes all occurrences of a repeated string, the first included
    cut = dedup_substrings(read_test_table(spark, sf_dir, "documents"), min_bytes=400, keep_first=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(read_test_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_test_table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE), capacity=2048, end_id=0)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_test_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, count="n_entities")


def op6_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_test_table(spark, sf_dir, "documents"))


def op7_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_test_table(spark, sf_dir, "documents"), tokenizer_file(WORD_BPE))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_test_table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE), limit=1024)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_test_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = with_quality(docs, read_test_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *(f"__quality.{c}" for c in MEASURES))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = similar_groups(read_test_table(spark, sf_dir, "documents"), width=3, percent=90)
    return groups.selectExpr("doc AS doc_id", "n AS n_shingles", "component AS component_id")


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(vocabulary(read_test_table(spark, sf_dir, "documents")))


def op12_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(read_test_table(spark, sf_dir, "documents"), read_test_table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(read_test_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nn_descent": op1_nn_descent,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_collinear_chaining": op6_collinear_chaining,
    "op7_bpe_stream": op7_bpe_stream,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_spelling_groups": op11_spelling_groups,
    "op12_rule_ensemble": op12_rule_ensemble,
    "op13_vector_codes": op13_vector_codes,
}

def _lloyd_sql(positions: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds over parts as chained tables; ``least`` packs distance and entry."""
    ctes = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS rid,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, p, list_slice(v, p * (len(v) // {positions}) + 1, (p + 1) * (len(v) // {positions})) AS part FROM kept, range({positions}) r(p)),
book0 AS MATERIALIZED (SELECT p, rid AS e, part AS c FROM parts WHERE rid < {entries})"""]
    for k in range(rounds + 1):
        ctes.append(f"""
near{k} AS MATERIALIZED (
  SELECT rid, p, any_value(part) AS part,
         min(CAST(list_sum(list_transform(list_zip(part, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {entries} + e) AS least
  FROM parts JOIN book{k} USING (p) GROUP BY rid, p)""")
        if k < rounds:
            ctes.append(f"""
mean{k} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c FROM (
    SELECT p, least % {entries} AS e, i, CAST(sum(part[i]) AS BIGINT) AS s, count(*) AS n
    FROM near{k}, (SELECT unnest(range(1, 1 + (SELECT max(len(part)) FROM parts))) AS i) GROUP BY ALL) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(mean{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN mean{k} USING (p, e))""")
    return "WITH" + ",".join(ctes) + f""",
coded AS (
  SELECT rid, string_agg(printf('%02x', least % {entries}), '' ORDER BY p) AS code, CAST(sum(least // {entries}) AS BIGINT) AS error
  FROM near{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (rid)"""


ORACLE_SQL: dict[str, str] = {"op13_vector_codes": _lloyd_sql()}
