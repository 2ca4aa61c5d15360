"""Column expressions; all of them stay on the JVM side."""

from stocklake.functions.dates import (
    calendar_columns,
    http_date,
    millis_to_ts,
    parse_compact_ts,
)
from stocklake.functions.text import (
    blank_to_null,
    clamp_score,
    clamp_scores,
    default_text,
    null_defaults,
    rename,
    replace_text,
    text_or_default,
    trim_columns,
)

__all__ = [
    "blank_to_null",
    "calendar_columns",
    "clamp_score",
    "clamp_scores",
    "default_text",
    "http_date",
    "millis_to_ts",
    "null_defaults",
    "parse_compact_ts",
    "rename",
    "replace_text",
    "text_or_default",
    "trim_columns",
]
