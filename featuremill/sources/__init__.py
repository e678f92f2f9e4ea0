"""Readers, writers and SQL views."""

from featuremill.sources.files import (load_table, read_csv, read_json, read_tables,
                                       register_views, sanitize_columns, save_table)

__all__ = ["load_table", "read_csv", "read_json", "read_tables", "register_views",
           "sanitize_columns", "save_table"]
