"""Helpers shared by the corpus operators: Arrow batches, staged tables, text rules."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklake.session import shared_dir

HELD_OUT_FOLDS = 5
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that no model may learn from; a null id is never held out."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and give
    memory back when they can.

    Enough where all machines see that folder; elsewhere ship the package, as with
    ``--py-files``.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    environment.setdefault("MALLOC_ARENA_MAX", "1")


Batches = Iterator[pa.RecordBatch]


def map_arrow(
    df: DataFrame, run: Callable[[Batches], Batches], schema: str | T.StructType, rows: int = 256
) -> DataFrame:
    """``df.mapInArrow`` that hands over batches of at most ``rows`` rows: a batch of
    Spark's has thousands, too many for whole documents and what is made of them."""
    reach(df.sparkSession)

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows)

    return df.mapInArrow(lambda batches: run(cut(batches)), schema)


def packed(df: DataFrame, names: Iterable[str]) -> Column:
    """The named columns as one struct ``row``, so that no name of theirs can clash."""
    return F.struct(*[F.col(f"`{name}`") for name in names]).alias("row")


def with_fields(df: DataFrame, names: Iterable[str], made: str) -> T.StructType:
    """The schema of the named columns of ``df`` and those of ``made``, in DDL."""
    return T.StructType([df.schema[name] for name in names] + T.StructType.fromDDL(made).fields)


class Staging:
    """Tables of one run below the shared folder, written once and read again.

    Everything lies in one folder named by a random id, so runs never meet and a
    lifecycle rule on the shared folder can remove it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/stocklake/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))
