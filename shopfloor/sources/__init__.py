"""Readers."""

from shopfloor.sources.files import (
    preview,
    read_csv,
    read_json_documents,
    read_json_lines,
    read_sheets,
    read_table,
)
from shopfloor.sources.jdbc import jdbc_options, read_jdbc_query, read_jdbc_table

__all__ = [
    "jdbc_options", "preview", "read_csv", "read_jdbc_query", "read_jdbc_table",
    "read_json_documents", "read_json_lines", "read_sheets", "read_table",
]
