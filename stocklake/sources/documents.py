"""JSON array documents too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklake.session import stage

#: Where the text reader cuts: every record of an array of objects ends with it.
SEPARATOR = "}"


def _depth(text: Column) -> Column:
    """How many more brackets a text opens than it closes."""
    opened = F.length(F.regexp_replace(text, r"[^\[{]", ""))
    return opened - F.length(F.regexp_replace(text, r"[^\]}]", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between separators, with its split and place, its quotes, and the change of
    depth with the separator behind it, if it begins outside a string or inside one."""
    read = spark.read.option("lineSep", SEPARATOR).text(path)
    rows = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
        # An escape never holds the separator, so none reaches into the next piece.
        F.regexp_replace("value", r"\\(?s:.)", "").alias("plain"),
    )
    quotes = F.length("plain") - F.length(F.regexp_replace("plain", '"', ""))
    strings = '"[^"]*("|$)'

    def change(text: Column, inside: int) -> Column:
        closes = (F.col("quotes") + inside) % 2 == 0
        return _depth(F.regexp_replace(text, strings, "")) - closes.cast("int")

    behind = F.regexp_replace("plain", '^[^"]*("|$)', "")
    return rows.withColumn("quotes", quotes).select(
        "file", "block", "place", "value", "quotes",
        change(F.col("plain"), 0).alias("outside"), change(behind, 1).alias("inside"),
    )


def _split_starts(pieces: DataFrame) -> DataFrame:
    """Per split whether it begins in a string (``in_string``, 0 or 1), and at what depth.

    Only numbers are shuffled. A split does not know how it begins, so both cases are
    summed up, and the right one is taken along the few splits of a file.
    """
    earlier = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    numbers = pieces.select("file", "block", "place", "quotes", "outside", "inside")
    splits = numbers.withColumn("odd", odd).groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"),
        F.sum(F.when(F.col("odd"), F.col("inside")).otherwise(F.col("outside"))).alias("as_outside"),
        F.sum(F.when(F.col("odd"), F.col("outside")).otherwise(F.col("inside"))).alias("as_inside"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    gained = F.when(F.col("in_string") == 1, F.col("as_inside")).otherwise(F.col("as_outside"))
    depth = F.coalesce(F.sum(gained).over(before), F.lit(0))
    return begun.select("file", "block", "in_string", depth.alias("depth"))


def _fragments(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Records, or the parts of one that a split's ends cut: ``file, block, number`` within
    the split, ``text`` and whether a record ends there."""
    order = Window.partitionBy("file", "block").orderBy("place")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = pieces.join(starts, ["file", "block"])
    state = (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) + F.col("in_string")) % 2
    change = F.when(F.col("state") == 1, F.col("inside")).otherwise(F.col("outside"))
    rows = rows.withColumn("state", state).withColumn("level", F.col("depth") + F.sum(change).over(so_far))
    closed = (F.col("level") == 1) & ((F.col("state") + F.col("quotes")) % 2 == 0)
    rows = rows.withColumn("ends", closed)
    number = F.coalesce(F.sum(F.col("ends").cast("int")).over(earlier), F.lit(0))
    parts = F.array_sort(F.collect_list(F.struct("place", "value")))
    return rows.withColumn("number", number).groupBy("file", "block", "number").agg(
        F.concat(F.array_join(parts["value"], SEPARATOR), F.lit(SEPARATOR)).alias("text"),
        F.bool_or("ends").alias("ends"),
    )


def read_split_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON array documents of objects, however they are laid out, each document
    read by as many tasks as it has splits.

    The text reader cuts at every ``}``; a running count of quotes and brackets tells which
    of them ends a record. Splits are put right by what their predecessors add up to, and
    records that reach over splits are put together. Memory holds a split in a task
    (``spark.sql.files.maxPartitionBytes``) and a record in a row. Files are read twice, and
    their text is shuffled once, by split.

    A document that is cut short, has anything beside objects in its array or behind it, or
    a record that does not parse, is an error. Fields the schema lacks are ignored, those a
    record lacks are null; an empty file or array has no rows.
    """
    pieces = _pieces(spark, path)
    starts = stage(_split_starts(pieces), "split-starts")
    fragments = stage(_fragments(pieces, starts), "fragments")
    # A fragment that neither begins nor ends its split is a record; the others are at most
    # two a split.
    whole = F.col("ends") & (F.col("number") > 0)
    records = fragments.where(whole).select("text", F.lit(False).alias("first"), "ends")
    order = Window.partitionBy("file").orderBy("block", "number")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    record = F.coalesce(F.sum(F.col("ends").cast("int")).over(earlier), F.lit(0))
    parts = F.array_sort(F.collect_list(F.struct("block", "number", "text")))
    # The separator behind a part that ends its split is one that was read there.
    edges = fragments.where(~whole).withColumn("record", record).groupBy("file", "record").agg(
        F.array_join(parts["text"], "").alias("text"),
        (F.col("record") == 0).alias("first"),
        F.bool_or("ends").alias("ends"),
    )
    # Behind the last record there has to be something, or the document is cut short.
    place = F.struct("block", "number")
    cut = fragments.groupBy("file").agg(F.max_by("ends", place).alias("ends")).where("ends")
    cut = cut.select(F.concat(F.lit("cut short: "), "file").alias("text"), F.lit(False).alias("first"), "ends")
    rows = records.unionByName(edges.select("text", "first", "ends")).unionByName(cut)
    # What is left behind the last record: the closing bracket, and the separator put there.
    text, first = F.col("text"), F.col("first")
    tail = F.when(first, text.rlike(r"^\s*(\[\s*\]\s*)?}$")).otherwise(text.rlike(r"^\s*\]\s*}$"))
    begun = F.when(first, text.rlike(r"^\s*\[\s*\{")).otherwise(text.rlike(r"^\s*,\s*\{"))
    broken = F.raise_error(F.concat(F.lit("no array of objects: "), F.substring("text", 1, 200)))
    sound = F.when(F.col("ends"), begun).otherwise(tail)
    record = F.when(~sound, broken.cast("string")).when(
        F.col("ends"), F.regexp_replace("text", r"^\s*[\[,]\s*", "")
    )
    rows = rows.select(record.alias("text")).where("text is not null")
    return rows.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
