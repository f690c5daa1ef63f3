"""Input readers."""

from callstats.sources.cdr import NULL_TEXT, header_schema, null_text, read_cdr, read_result, read_table

__all__ = ["NULL_TEXT", "header_schema", "null_text", "read_cdr", "read_result", "read_table"]
