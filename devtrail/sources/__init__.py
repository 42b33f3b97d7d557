"""Sources and sinks: positional delimited text, Parquet, test-table feeds."""

from .text import LAYOUTS, Layout, read_delimited, read_lines, render, to_lines, write_delimited, write_table

__all__ = ["LAYOUTS", "Layout", "read_delimited", "read_lines", "render", "to_lines", "write_delimited", "write_table"]
