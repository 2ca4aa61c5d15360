"""File readers. Every reader takes a declared schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklake.functions.dates import as_date


def _json_reader(spark: SparkSession, schema, skip_broken: bool):
    """A broken record ends the read, or with ``skip_broken`` is left out."""
    mode = "DROPMALFORMED" if skip_broken else "FAILFAST"
    return spark.read.schema(schema).option("mode", mode)


def read_json_array(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    one_document_per_line=False,
    skip_broken=False,
) -> DataFrame:
    """Rows of JSON array documents.

    A pretty-printed document cannot be split, so each such file is one task. With
    ``one_document_per_line`` (what ``write_json_array`` lands) files are splittable.
    """
    reader = _json_reader(spark, schema, skip_broken)
    return reader.option("multiLine", not one_document_per_line).json(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, skip_broken=False
) -> DataFrame:
    """One record per line; blank lines are skipped."""
    return _json_reader(spark, schema, skip_broken).json(path)


def latest_file(spark: SparkSession, directory: str, extension: str = "json") -> DataFrame:
    """One row: the path changed last among the folder's own files with this extension.

    Files in folders below it, such as those of a day, do not count. Only path and
    modification time are selected, so no file content is read. ``path`` is null when
    there is no such file.
    """
    pattern = f"{directory}/*.{extension}"
    files = if_found(lambda: spark.read.format("binaryFile").load(pattern))
    if files is None:
        return spark.createDataFrame([(None,)], "path STRING")
    return files.select("path", "modificationTime").agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    )


def read_latest_json_array(
    spark: SparkSession, directory: str, schema: T.StructType, missing_ok=False
) -> DataFrame:
    """Rows of the newest ``.json`` document in a folder.

    A folder without one is an error unless ``missing_ok``, which gives no rows.
    """
    path = latest_file(spark, directory).first()["path"]
    if path is None:
        if not missing_ok:
            raise FileNotFoundError(f"no .json document in {directory}")
        return spark.createDataFrame([], schema)
    return read_json_array(spark, path, schema)


def if_found(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _read_or_empty(spark, read, schema, missing_ok):
    if not missing_ok:
        return read()
    found = if_found(read)
    if found is not None:
        return found
    # The filter tells the planner that there are no rows, so it leaves out joins with them.
    return spark.createDataFrame([], schema).where(F.lit(False))


def read_texts(spark: SparkSession, path: str, missing_ok=False) -> DataFrame:
    """Payload texts, one per line, in a column ``value``."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    return _read_or_empty(
        spark, lambda: spark.read.text(path).select("value"), schema, missing_ok
    )


def read_partition(
    spark: SparkSession, root: str, run_date, schema: T.StructType, missing_ok=False
) -> DataFrame:
    """One day of a daily table, with its ``dt`` column.

    Only that day's folder is listed, however many days the table holds. A missing
    day is an error unless ``missing_ok``, which gives an empty frame.
    """
    full = T.StructType(schema.fields + [T.StructField("dt", T.DateType())])
    leaf = f"{root}/dt={as_date(run_date).isoformat()}"
    reader = spark.read.schema(full).option("basePath", root)
    return _read_or_empty(spark, lambda: reader.parquet(leaf), full, missing_ok)


def read_key(
    spark: SparkSession, path: str, schema: T.StructType, key: str, value: int, width: int
) -> DataFrame:
    """The rows with one key of a table written by ``append_key_ranges``.

    Only the folder of the key's range is listed and read; no such folder, no rows.
    """
    leaf = f"{path}/{key}_range={value // width}"
    rows = _read_or_empty(spark, lambda: spark.read.schema(schema).parquet(leaf), schema, True)
    return rows.where(F.col(key) == F.lit(value))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, missing_ok=False
) -> DataFrame:
    """A whole Parquet table under its declared schema."""
    reader = spark.read.schema(schema)
    return _read_or_empty(spark, lambda: reader.parquet(path), schema, missing_ok)
