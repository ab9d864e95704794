"""Sinks: file layouts, JDBC, and the empty-output guard."""

from ledgerline.sinks.files import (
    is_empty,
    write_compacted,
    write_csv,
    write_json_documents,
    write_ndjson,
    write_partitioned,
    write_unless_empty,
)
from ledgerline.sinks.jdbc import jdbc_write_options, read_jdbc, write_jdbc

__all__ = [
    "is_empty", "jdbc_write_options", "read_jdbc", "write_compacted", "write_csv",
    "write_jdbc", "write_json_documents", "write_ndjson", "write_partitioned",
    "write_unless_empty",
]
