"""The corpus operators over the given tables, one query each."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from stocklake.llm import (
    bytepair,
    chat,
    decontam,
    filteraudit,
    langid,
    linededup,
    minhash,
    packing,
    phrases,
    pii,
    topk,
    toxicity,
    warc,
)
from stocklake.llm.common import load


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The vocabulary file, by the package that brings it."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(load(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(load(spark, sf_dir, "pages"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(load(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.decontaminate(documents, load(spark, sf_dir, "benchmark")).drop("text")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of marks."""
    chats = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)], chats.schema)
    return chat.chat_digests(chat.format_chats(chats.unionByName(extra)))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path())


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(documents).drop("text")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load(spark, sf_dir, "embeddings"))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepair.round_trip(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(load(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


REGISTERED = {
    run.__name__: run
    for run in (
        op1_language_id,
        op2_warc,
        op3_minhash,
        op4_decontaminate,
        op5_chat_format,
        op6_pack,
        op7_pii,
        op8_line_dedup,
        op9_toxicity,
        op10_top_k,
        op11_byte_pairs,
        op12_phrases,
        op13_filter_audit,
    )
}
