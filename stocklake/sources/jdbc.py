"""Relational source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    **options,
) -> dict[str, str]:
    """Reader options for a whole table or for a query the database evaluates.

    A partitioned read needs all four partitioning arguments and a table: without
    them one task reads everything.
    """
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    ranges = {
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": num_partitions,
    }
    given = {k: str(v) for k, v in ranges.items() if v is not None}
    if given and (len(given) < len(ranges) or query is not None):
        raise ValueError("a partitioned read needs a table, a column, bounds and a number")
    target = {"dbtable": table} if table is not None else {"query": query}
    return {"url": url, **target, **given, **{k: str(v) for k, v in options.items()}}


def read_jdbc(spark: SparkSession, url: str, **options) -> DataFrame:
    """``table=`` reads a table, ``query=`` pushes joins and filters to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    """Write rows; choose the winners with ``insert_ignore`` first.

    Each task is its own transaction, so load into an empty staging table where the
    database has to see all rows or none.
    """
    df.write.format("jdbc").options(**jdbc_options(url, table=table, **options)).mode(
        mode
    ).save()
