"""Surrogate keys without a single-task numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklake.session import stage, staging_path


def next_key(target: DataFrame, key: str) -> Column:
    """The highest key in use, 0 for an empty table, as a scalar subquery."""
    return F.coalesce(target.agg(F.max(key)).scalar(), F.lit(0))


def assign_keys(
    df: DataFrame, order_cols: list[str], key_name: str, start: int | Column = 0
) -> DataFrame:
    """Dense keys ``start + 1, start + 2, ...`` in the order of a natural key.

    The rows are range-sorted once into a staged table in the shared folder. A row's
    key is its place within its file plus the sizes of the files before, so the only
    thing numbered in one task is the list of files. A retried task reads the same
    files again and therefore gives the same keys. Rows that tie on the natural key
    are told apart by a hash of the rest; drop copies first.
    """
    rest = [c for c in df.columns if c not in order_cols]
    order = [F.col(c) for c in order_cols] + ([F.xxhash64(*rest)] if rest else [])
    return number_sorted(df.repartitionByRange(*order).sortWithinPartitions(*order), key_name, start)


def number_sorted(df: DataFrame, key_name: str, start: int | Column = 0) -> DataFrame:
    """``assign_keys`` of rows that lie sorted in ranges already."""
    path = staging_path(df.sparkSession, "keys")
    df.write.option("compression", "zstd").parquet(path)
    return number_files(df.sparkSession.read.schema(df.schema).parquet(path), key_name, start)


def number_files(staged: DataFrame, key_name: str, start: int | Column = 0) -> DataFrame:
    """``number_sorted`` of a staged table, whose files follow one another by their numbers."""
    rows = staged.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    file_no = F.regexp_extract("_file", r"part-(\d+)-", 1).cast("int")
    before = Window.orderBy(file_no, "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    offsets = files.select(
        "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    start = start if isinstance(start, Column) else F.lit(start)
    key = (start + F.col("_offset") + F.col("_row") + 1).cast("long")
    # One row per file: as many as the shuffle had partitions. Staged, so that its size
    # is known and the planner decides how to join.
    offsets = stage(offsets, "key-offsets")
    return rows.join(offsets, "_file").select(key.alias(key_name), *staged.columns)


def bucketed_keys(
    df: DataFrame,
    natural_key: list[str],
    key_name: str,
    prefix: int = 0,
    buckets: int = 1 << 16,
) -> DataFrame:
    """Unique, repeatable keys with gaps, from one shuffle and nothing staged.

    For fact loads: rows are numbered within hash buckets of their natural key, and
    bucket b takes the numbers b + 1, b + 1 + buckets, and so on. ``prefix`` (the
    day's key) goes above bit 40, so each day has its own numbers and a rerun of a
    day gives the same ones; a bucket too full for the numbers below that bit is an
    error. Drop copies first: rows equal in ``natural_key`` meet in one bucket.
    """
    bucket = F.pmod(F.xxhash64(*natural_key), F.lit(buckets))
    within = Window.partitionBy("_bucket").orderBy(*natural_key)
    number = (F.row_number().over(within).cast("long") - 1) * buckets + F.col("_bucket") + 1
    full = F.raise_error(F.lit(f"{key_name}: a bucket of day {prefix} has no numbers left"))
    key = F.lit(prefix << 40) + F.when(number < 1 << 40, number).otherwise(full.cast("long"))
    return df.withColumn("_bucket", bucket).select(key.alias(key_name), *df.columns)
