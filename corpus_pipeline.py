"""The corpus pipeline: stages that each read what the one before has written.

A stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of
``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklake.llm import decontam, langid, linededup, minhash, packing
from stocklake.llm.common import Staging, load
from stocklake.llm.common import packed as packed_row
from stocklake.llm.queries import tokenizer_path

#: Documents whose best language is less likely than this are rejected, as are those
#: without a letter.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a known language; a model is learned from the labelled ones.

    Documents whose text reads like none of the learned languages go, as do those between two
    of them, without a letter, empty or null; ties go to the language that sorts first.
    Repeated rows are judged alike, an empty table gives none.
    """
    whole = docs.select(packed_row(docs, docs.columns), "text")
    named = langid.identify(whole, langid.train(docs), keep=["row"])
    sure = (F.col("lang_pred") != langid.UNKNOWN) & F.col("known") & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return named.where(sure).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines; ``n_chars`` follows the text.

    No row is lost: a null text becomes an empty one, rows of one id are one document, a null
    id is below all others.
    """
    others = [c for c in docs.columns if c != "text"]
    out = linededup.dedup_lines(docs.select(packed_row(docs, others), "doc_id", "text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least id of each group of near duplicates.

    Rows of one id stay or go together; a null id, and texts without words, stay.
    """
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark; each row is judged by its own
    text, null and empty ones stay."""
    whole = docs.select(packed_row(docs, docs.columns), "text")
    searched = decontam.decontaminate(whole, load(spark, sf_dir, "benchmark"))
    return searched.where("not contaminated").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; every row is packed, a null text as an empty one."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("packed", packed),
]

#: Language models, shingle sets and tokens are beyond SQL; tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    staging = Staging(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staging.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
