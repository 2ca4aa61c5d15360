"""Text cleaning, defaults and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as blank. (?U) makes \s cover non-breaking and other
# Unicode spaces; U+001C to U+001F are the separators it still leaves out.
BLANK = r"(?U)^[\s\x1c-\x1f]*$"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def blank_to_null(df: DataFrame, cols=None) -> DataFrame:
    """Empty and whitespace-only strings become null."""
    cols = string_columns(df) if cols is None else cols
    return df.withColumns({c: F.when(~F.col(c).rlike(BLANK), F.col(c)) for c in cols})


def trim_columns(df: DataFrame, cols) -> DataFrame:
    """Strip spaces (not tabs) from both ends."""
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def replace_text(df: DataFrame, col: str, pattern: str, replacement: str) -> DataFrame:
    """Replace every match of a regular expression."""
    return df.withColumn(col, F.regexp_replace(F.col(col), pattern, replacement))


def text_or_default(col: Column, default: str = "n/a") -> Column:
    """Trimmed text, or the default for null. An empty string stays empty."""
    return F.coalesce(F.trim(col.cast("string")), F.lit(default))


def default_text(df: DataFrame, cols, default: str = "n/a") -> DataFrame:
    return df.withColumns({c: text_or_default(F.col(c), default) for c in cols})


def lenient_double(col: Column) -> Column:
    """Text as a double, null if it is none.

    A failed cast costs as much as parsing a hundred numbers, so it is not tried on text
    that cannot be one: without a digit it is not, unless it names infinity or NaN. Most text
    starts with a digit or a sign, which is told by its place in the order of texts.
    """
    text = col.cast("string")
    signed = text.between("+", ":")
    return F.when(signed | text.rlike("[0-9]|(?i)inf|nan"), text.try_cast("double"))


def clamp_score(col: Column) -> Column:
    """A score as a double: negative, null or unparseable gives 0.0."""
    return F.greatest(F.coalesce(lenient_double(col), F.lit(0.0)), F.lit(0.0))


def clamp_number(col: Column) -> Column:
    """The same of a column that is a number already."""
    return F.greatest(F.coalesce(col.cast("double"), F.lit(0.0)), F.lit(0.0))


def clamp_scores(df: DataFrame, cols) -> DataFrame:
    texts = set(string_columns(df))
    return df.withColumns({c: (clamp_score if c in texts else clamp_number)(F.col(c)) for c in cols})


def null_defaults(df: DataFrame, values: dict) -> DataFrame:
    """Fill nulls per column, keeping each column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in values.items()}
    )


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    return df.withColumnsRenamed(mapping)
