"""Line deduplication over levelled sorted runs of line hashes.

A run is a table bucketed and sorted by line hash. A batch of documents is reduced to one
row per hash and merge-anti-joined with the runs: the hashes none of them has become a run
of level 0. Of the others only counts are kept, beside the runs. ``fanout`` runs of a level
are compacted into one of the next. All share the bucketing, so the joins read them in place.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklake.llm.common import Staging, map_arrow, packed, with_fields

MIN_CHARS = 40
MIN_DOCS = 5
#: Stands for a null id: one document, below all others.
NO_ID = -(1 << 63)
MADE = ("n_lines", "n_dropped", "kept_sha256")
CONTINUATION = bytes(range(0x80, 0xC0))


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line stripped of ASCII white space and lower-cased in A-Z, if long enough."""
    key = line.strip()
    if len(key) < min_chars or (
        not key.isascii() and len(key.translate(None, CONTINUATION)) < min_chars
    ):
        return None
    return key.lower()


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def line_hashes(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``hash, doc``: each long enough line of each document once."""

    def run(batches):
        for batch in batches:
            hashes, docs = [], []
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if not text or len(text) < min_chars:
                    continue
                keys = (line_key(line, min_chars) for line in text.encode("utf-8", "replace").split(b"\n"))
                found = {_hash(key) for key in keys if key is not None}
                hashes.extend(found)
                docs.extend([doc] * len(found))
            yield pa.record_batch(
                [pa.array(hashes, pa.binary()), pa.array(docs, pa.int64())], names=["hash", "doc"]
            )

    rows = df.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")
    return map_arrow(rows, run, "hash binary, doc long")


class LineRuns:
    """The index: runs of ``hash, docs, holder, settled`` and counts of ``hash, docs``.

    Every hash is in one run, that of the first batch which had it: ``holder`` is that
    batch's largest document, the largest of all if batches come in descending order of ids,
    and ``docs`` that batch's documents. Later batches add to the counts alone, and nothing
    once a compaction has found the hash settled: in ``min_docs`` documents. Runs and counts
    live as bucketed tables in the shared folder until ``drop()``.
    """

    def __init__(
        self, spark: SparkSession, fanout: int = 4, buckets: int | None = None, min_docs: int = MIN_DOCS
    ):
        self.spark = spark
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.min_docs = min_docs
        self.staging = Staging(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.counts: list[str] = []
        self.written = 0

    def _write(self, rows: DataFrame) -> str:
        self.written += 1
        name = f"run_{self.staging.root[-32:]}_{self.written}"
        (
            rows.write.bucketBy(self.buckets, "hash")
            .sortBy("hash")
            .option("path", self.staging.path(name))
            .saveAsTable(name)
        )
        return name

    def _files(self, names: list[str]) -> DataFrame:
        # Read as plain files: a union of bucketed scans claims a partitioning it does not
        # have, and sums over it come out in parts.
        schema = self.spark.table(names[0]).schema
        return self.spark.read.schema(schema).parquet(*[self.staging.path(n) for n in names])

    def _forget(self, names: list[str]) -> None:
        # From the catalog only: files stay until what is read from them is done.
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def unseen(self, keyed: DataFrame) -> DataFrame:
        """The rows whose hash no run has: a merge anti join with each run in turn."""
        for name in self.runs():
            keyed = keyed.join(self.spark.table(name).select("hash").hint("merge"), "hash", "left_anti")
        return keyed

    def add(self, lines: DataFrame) -> None:
        """Take in a batch of ``hash, doc`` rows, each pair once. A document must not
        come in two batches."""
        rows = lines.groupBy("hash").agg(F.count("*").alias("docs"), F.max("doc").alias("holder"))
        name = self._write(rows)
        batch = self.spark.table(name)
        # Each hash is in one run, so no row of the batch is counted twice.
        for run in self.runs():
            open_ = self.spark.table(run).where("not settled").select("hash").hint("merge")
            self.counts.append(self._write(batch.select("hash", "docs").join(open_, "hash", "left_semi")))
        fresh = self.unseen(batch).withColumn("settled", F.col("docs") >= self.min_docs)
        self._push(0, self._write(fresh))
        self._forget([name])

    def _push(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            merged = self._write(self._compacted(old))
            self.levels[level] = []
            self._forget(old)
            self._push(level + 1, merged)

    def _compacted(self, names: list[str]) -> DataFrame:
        """Runs of one level as one; the counts, made one as well, tell what is settled."""
        rows = self._files(names)
        if not self.counts:
            return rows
        old = self.counts
        summed = self._files(old).groupBy("hash").agg(F.sum("docs").alias("docs"))
        self.counts = [self._write(summed)]
        self._forget(old)
        more = self.spark.table(self.counts[0]).withColumnRenamed("docs", "_more")
        total = F.col("docs") + F.coalesce(F.col("_more"), F.lit(0))
        return rows.join(more, "hash", "left").select(
            "hash", "docs", "holder", (F.col("settled") | (total >= self.min_docs)).alias("settled")
        )

    def merged(self) -> DataFrame | None:
        """All hashes with their counts: ``hash, docs, holder``. A settled hash has at least
        ``min_docs`` documents, but not all of them are counted."""
        names = self.runs()
        if not names:
            return None
        rows = self._files(names).select("hash", "docs", "holder")
        if not self.counts:
            return rows
        counts = self._files(self.counts).select("hash", "docs", F.lit(None).cast("long").alias("holder"))
        return rows.unionAll(counts).groupBy("hash").agg(
            F.sum("docs").alias("docs"), F.max("holder").alias("holder")
        )

    def drop(self) -> None:
        self._forget([*self.runs(), *self.counts])
        self.levels, self.counts = [], []


#: A batch has about so many bytes of text, but a table is dealt to ``BATCHES`` at least.
BATCH_BYTES = 1 << 36
BATCHES = 4
#: A run has a bucket for so many bytes of all texts, but one per shuffle partition at least.
BUCKET_BYTES = 1 << 30


def _dealt(documents: DataFrame, batches: int | None) -> tuple[int, int, Column]:
    """The number of batches, the bytes of all texts, and a document's batch by its id: 0 is
    that of the largest ids, a null id is in the last."""
    extent = documents.agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum(F.octet_length("text")).alias("size")
    ).first()
    low, high, size = extent.low, extent.high, extent.size or 0
    batches = batches or max(BATCHES, -(-size // BATCH_BYTES))
    if low is None:
        return 1, size, F.lit(0)
    width = (high - low) // batches + 1
    below = F.lit(int(high)).cast("decimal(20,0)") - F.col("doc")
    number = F.floor(below / F.lit(width)).cast("int")
    return batches, size, F.when(F.col("doc") >= int(low), number).otherwise(batches - 1)


def dedup_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int | None = None,
    fanout: int = 4,
) -> DataFrame:
    """All columns of the documents with the text less its repeated lines, and ``n_lines``
    (before), ``n_dropped``, ``kept_sha256``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys
    of ``min_chars`` code points that ``min_docs`` documents hold lose all lines but those
    of the largest ``doc_id``. A null or empty text is one empty line; a null text
    becomes an empty one. Rows of one id are one document; a null id is one document
    below all others. Columns with the names of the three added ones are replaced.

    Ids come in ranges of about ``BATCH_BYTES`` of text (``batches``: so many ranges). Texts
    are read for their hashes once, which are staged by batch. A hash is 128 bits long. A
    line that a third of all documents hold is one row per task and batch after the map-side
    sum; the join of lines with repeated hashes splits such a key.
    """
    spark = documents.sparkSession
    batches, size, number = _dealt(documents, batches)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    runs = LineRuns(spark, fanout, buckets, min_docs)
    hashes = line_hashes(documents, min_chars)
    path = runs.staging.path("hashes")
    hashes.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    staged = spark.read.schema(T.StructType([*hashes.schema, T.StructField("batch", T.IntegerType())])).parquet(path)
    for batch in range(batches):
        runs.add(staged.where(F.col("batch") == batch).select("hash", "doc").distinct())
    repeated = runs.merged().where(F.col("docs") >= min_docs).select("hash", "holder")
    repeated = runs.staging.write(repeated, "repeated")
    runs.drop()
    lost = (
        staged.select("hash", "doc")
        .join(repeated, "hash")
        .where("doc <> holder")
        .groupBy("doc")
        .agg(F.collect_set("hash").alias("lost"))
    )
    columns = [c for c in documents.columns if c not in (*MADE, "text")]
    rows = (
        documents.select(
            packed(documents, columns),
            "text",
            F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        )
        .join(lost, "doc", "left")
        .select("row", "text", "lost")
    )

    def strip(batches):
        for batch in batches:
            texts, before, gone, shas = [], [], [], []
            for text, lost in zip(batch["text"].to_pylist(), batch["lost"].to_pylist(), strict=True):
                lines = (text or "").encode("utf-8", "replace").split(b"\n")
                kept = lines
                if lost:
                    lost = set(lost)
                    kept = [
                        line
                        for line in lines
                        if (key := line_key(line, min_chars)) is None or _hash(key) not in lost
                    ]
                joined = b"\n".join(kept)
                texts.append(joined.decode())
                before.append(len(lines))
                gone.append(len(lines) - len(kept))
                shas.append(hashlib.sha256(joined).hexdigest())
            yield pa.record_batch(
                [
                    batch["row"],
                    pa.array(texts, pa.string()),
                    pa.array(before, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(shas, pa.string()),
                ],
                names=["row", "text", *MADE],
            )

    schema = with_fields(rows, ["row"], "text string, n_lines long, n_dropped long, kept_sha256 string")
    return map_arrow(rows, strip, schema).select("row.*", "text", *MADE)
