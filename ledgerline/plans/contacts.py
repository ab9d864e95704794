"""Contacts: full name, keep comments containing a digit, sort, write to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import contains_match, full_name
from ledgerline.operators.aggregate import sort_by
from ledgerline.sinks.jdbc import write_jdbc
from ledgerline.sources.files import read_csv, string_schema

CONTACT_SCHEMA = string_schema("last_name", "first_name", "comment")


def contacts_with_full_name(
    contacts: DataFrame,
    pattern: str = r"\d+",
    sort: bool = True,
) -> DataFrame:
    """Add ``full_name = last_name ‖ ", " ‖ first_name`` and keep rows whose
    whole ``comment`` contains ``pattern``; optionally sort by ``last_name``
    ascending (nulls first).  The sort is a range-partitioned shuffle -- skip
    it when the sink does not keep order (a database table does not).
    """
    out = contacts.withColumn("full_name", full_name("last_name", "first_name")).filter(
        contains_match("comment", pattern)
    )
    if sort:
        out = sort_by(out, [F.col("last_name").asc()])
    return out


def read_contacts(spark: SparkSession, path: str, escape: str | None = None) -> DataFrame:
    """Header CSV, every column a string (no inference pass)."""
    return read_csv(spark, path, schema=CONTACT_SCHEMA, escape=escape)


def run_contacts(
    spark: SparkSession,
    csv_path: str,
    url: str,
    table: str,
    properties: dict[str, str],
    pattern: str = r"\d+",
) -> DataFrame:
    """CSV -> full name + digit filter -> JDBC table (overwrite).  Returns the written frame."""
    out = contacts_with_full_name(read_contacts(spark, csv_path), pattern, sort=False)
    write_jdbc(out, url, table, properties)
    return out
