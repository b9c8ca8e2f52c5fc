"""Sinks: Parquet by run or attempt, defined tables, a given number of files, JDBC."""

from ledgerline.sinks.jdbc import append_new_rows, read_jdbc, write_jdbc
from ledgerline.sinks.parquet import (
    DefinitionMismatch, conform, conform_to, define_table, ensure_table, insert_into, read_attempt, read_attempts,
    read_run_partition, table_definition, write_attempt, write_files, write_run_partition,
)

__all__ = [
    "DefinitionMismatch", "append_new_rows", "conform", "conform_to", "define_table", "ensure_table", "insert_into",
    "read_attempt", "read_attempts", "read_jdbc", "read_run_partition", "table_definition", "write_attempt",
    "write_files", "write_jdbc", "write_run_partition",
]
