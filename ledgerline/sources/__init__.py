"""Sources: file readers, catalog tables, in-memory rows, the generator and test tables."""

from ledgerline.sources.catalog import (
    drop_table,
    ensure_database,
    list_tables,
    read_table,
    use_database,
)
from ledgerline.sources.files import (
    TIMESTAMP_MICROS,
    TIMESTAMP_NTZ_MICROS,
    abfss_conf,
    abfss_uri,
    read_csv,
    read_json_documents,
    read_ndjson_tree,
    read_parquet,
    string_schema,
)
from ledgerline.sources.generate import generate_orders, order_columns
from ledgerline.sources.rows import from_rows

__all__ = [
    "TIMESTAMP_MICROS", "TIMESTAMP_NTZ_MICROS", "abfss_conf", "abfss_uri",
    "drop_table", "ensure_database", "from_rows", "generate_orders",
    "list_tables", "order_columns", "read_csv", "read_json_documents", "read_ndjson_tree",
    "read_parquet", "read_table", "string_schema", "use_database",
]
