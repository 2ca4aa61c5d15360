"""Row cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stocklake.functions.text import blank_to_null


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows; copies are combined on the map side before the shuffle."""
    return df.dropDuplicates()


def clean_rows(df: DataFrame, required=None) -> DataFrame:
    """Blank strings to null, distinct rows, no row with a null in ``required``.

    ``required`` defaults to all columns. Incomplete rows go first, so they are
    never shuffled; the result is the same as when they go last.
    """
    return dedup_rows(blank_to_null(df).na.drop("any", subset=required))
