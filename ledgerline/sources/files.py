"""File readers: CSV, multi-line JSON documents, NDJSON landing trees, Parquet.

Schema first: every reader takes an explicit ``StructType`` (or DDL string),
which avoids the inference pre-scan over the whole input and keeps the
column set stable when a file is malformed.  Inference stays available as an
option because the reference uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Timestamp text formats for writing JSON: Spark's JSON writer keeps only
#: milliseconds by default; these keep microseconds.  Readers set no format,
#: so Spark's ISO fallback parses any spelling (and keeps microseconds).
TIMESTAMP_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TIMESTAMP_NTZ_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

Schema = T.StructType | str | None


def string_schema(*names: str, nullable: bool = True) -> T.StructType:
    """All-string schema: what a header CSV without inference yields."""
    return T.StructType([T.StructField(n, T.StringType(), nullable) for n in names])


def _apply(reader, schema: Schema, options: dict | None):
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema = None,
    header: bool = True,
    infer_schema: bool = False,
    escape: str | None = None,
    mode: str = "PERMISSIVE",
    options: dict | None = None,
) -> DataFrame:
    """CSV scan.  Without ``schema`` and ``infer_schema`` every column is a string.

    ``infer_schema=True`` costs a full extra pass over the input; prefer an
    explicit schema at scale.  ``escape`` defaults to Spark's backslash, so a
    doubled quote inside a quoted field stays doubled (as in the reference).
    """
    opts = {"header": str(header).lower(), "mode": mode}
    if infer_schema and schema is None:
        opts["inferSchema"] = "true"
    if escape is not None:
        opts["escape"] = escape
    opts.update(options or {})
    return _apply(spark.read, schema, opts).csv(path)


def read_json_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema = None,
    options: dict | None = None,
) -> DataFrame:
    """Multi-line JSON: each file is one document (an object or an array of them).

    A document cannot be split, so each file is read by one task: keep files
    small (many files) when the input is large.
    """
    # no fixed time format: Spark's default parser falls back to ISO parsing
    # (any fraction up to microseconds, ``Z`` or an offset) when one is not given
    opts = {"multiLine": "true"}
    opts.update(options or {})
    return _apply(spark.read, schema, opts).json(path)


def read_ndjson_tree(
    spark: SparkSession,
    root: str | list[str],
    schema: Schema = None,
    file_glob: str = "*.ndjson",
    corrupt_column: str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Newline-delimited JSON under a landing tree such as ``year=/month=/day=/...``.

    Files at any depth below ``root`` are found (``recursiveFileLookup``); a
    plain ``**`` path glob would only descend one level.  Recursive lookup
    also switches off partition discovery, so directory names like
    ``pair=all`` never overwrite the data's own columns.  Files are splittable:
    large files are read by many tasks.

    With ``corrupt_column`` set (and present in ``schema`` as a string column)
    malformed lines are kept there instead of failing; see
    :func:`ledgerline.operators.quality.split_corrupt`.
    """
    opts = {
        "recursiveFileLookup": "true",
        "pathGlobFilter": file_glob,
        "mode": "PERMISSIVE",
    }
    if corrupt_column:
        opts["columnNameOfCorruptRecord"] = corrupt_column
    opts.update(options or {})
    return _apply(spark.read, schema, opts).json(root)


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema = None,
    options: dict | None = None,
) -> DataFrame:
    """Parquet scan.  Pass ``schema`` when reading a partitioned directory so
    partition values keep their written type (``"01"`` stays a string)."""
    paths = [path] if isinstance(path, str) else list(path)
    return _apply(spark.read, schema, options).parquet(*paths)


# --- object stores -------------------------------------------------------

def abfss_uri(container: str, account: str, path: str = "") -> str:
    """``abfss://container@account.dfs.core.windows.net/path``."""
    return f"abfss://{container}@{account}.dfs.core.windows.net/{path.lstrip('/')}"


def abfss_conf(account: str, account_key: str) -> dict[str, str]:
    """Session settings for key-based ABFS access.

    The key comes from the caller (secret store, environment); it is never
    written into code.  Needs the hadoop-azure module on the classpath.
    """
    return {
        f"spark.hadoop.fs.azure.account.key.{account}.dfs.core.windows.net": account_key,
        "spark.hadoop.fs.azure.impl": "org.apache.hadoop.fs.azurebfs.AzureBlobFileSystem",
    }
