"""Catalog helpers: databases, tables, and reading a table back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _ident(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``; ``location`` keeps its files in a shared folder."""
    sql = f"CREATE DATABASE IF NOT EXISTS {_ident(name)}"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Table names in ``database`` (``SHOW TABLES IN``), sorted."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan; bucketing metadata of the table is kept."""
    return spark.table(name)
