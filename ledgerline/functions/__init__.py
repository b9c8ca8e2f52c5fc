"""Column-level functions: every one is a built-in Spark expression."""

from ledgerline.functions.casts import bool_text, clean_watermark, numeric_id, parse_watermark
from ledgerline.functions.dates import DATE_FORMAT, DEFAULT_TZ, format_epoch, run_timestamp
from ledgerline.functions.text import join_names, times

__all__ = [
    "DATE_FORMAT", "DEFAULT_TZ", "bool_text", "clean_watermark", "format_epoch",
    "join_names", "numeric_id", "parse_watermark", "run_timestamp", "times",
]
