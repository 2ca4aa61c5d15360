import zlib

import numpy as np
import pytest
from conftest import SF
from stocklake.llm import packing
from stocklake.llm.queries import tokenizer_path
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def check(df, tokenizer, size=2048):
    texts = {}
    for r in df.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        texts.setdefault(r.doc_id, []).append(np.array(ids, "<u4"))
    pieces = packing.pack(df, tokenizer_path(), size).toPandas()
    for doc, own in texts.items():
        if len(own) > 1:
            continue
        mine = pieces[pieces.doc_id == doc] if doc is not None else pieces[pieces.doc_id.isna()]
        mine, at = mine.sort_values("start"), 0
        for piece in mine.itertuples():
            assert piece.start == at and piece.doc_tokens == len(own[0])
            assert zlib.crc32(own[0][at : at + piece.length].tobytes()) == piece.ids_crc32
            at += piece.length
        assert at == len(own[0])
    assert pieces.length.sum() == sum(len(ids) for own in texts.values() for ids in own)
    ordered = pieces.sort_values(["sequence_id", "offset"])
    groups = ordered.groupby("sequence_id")
    assert (groups.length.cumsum() - ordered.length == ordered.offset).all()
    return groups.length.sum()


def test_given_documents(spark, tokenizer):
    filled = check(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer)
    assert filled.max() <= 2048
    assert all(n & (n - 1) == 0 for n in filled)


def test_edges(documents, tokenizer):
    rows = [(1, None), (2, ""), (3, "  \x1c\x85 x"), (4, "<|endoftext|>a <|startoftext|> b<| c"), (None, "nothing")]
    rows += [(5, "It's NAÏVE — 123,456… don't!!!"), (6, "word " * 20_000), (7, "é ́ é Σας ΣΑΣ İ ﬁ"), (8, "x" * 30_000)]
    rows += [(9, "twice"), (9, "twice"), (10, "日本語 テキスト 🙂🙂"), (11, "a b​c﻿")]
    for size in (64, 2048):
        filled = check(documents(rows), tokenizer, size)
        assert filled.max() <= size and all(n & (n - 1) == 0 for n in filled)


def test_open_windows_meet_in_a_second_pass(spark, tokenizer):
    """With many small tasks most pieces are placed by the rule all the same, in few tasks."""
    df = spark.read.parquet(f"{SF}/documents.parquet").repartition(16, "doc_id")
    filled = check(df, tokenizer)
    short = filled[filled < 2048]
    assert len(short) <= 11 and short.is_unique
    for tails in (1, 20):
        pieces = packing.pack(df, tokenizer_path(), tails=tails).toPandas()
        assert (pieces.groupby("sequence_id").length.sum() <= 2048).all()
    again = packing.pack(df, tokenizer_path()).toPandas().sort_values(["doc_id", "start"])
    once = packing.pack(df, tokenizer_path()).toPandas().sort_values(["doc_id", "start"])
    assert again.reset_index(drop=True).equals(once.reset_index(drop=True))


def test_empty(documents):
    assert packing.pack(documents([(1, "a")]).limit(0), tokenizer_path()).count() == 0


def test_sum_of_squares_choice():
    """The level chosen is one that makes the sum of squares least."""
    rng = np.random.default_rng(0)
    bins = packing.SumOfSquares(20)
    for length in rng.integers(1, 20, 400).tolist():
        before = bins.count.copy()

        def after(level):
            count = before.copy()
            if level:
                count[level] -= 1
            if level + length < 20:
                count[level + length] += 1
            return int((count**2).sum())

        levels = [0, *(h for h in range(1, 20 - length + 1) if before[h])]
        level, window = bins.place(length)
        assert after(level) == min(map(after, levels))
        window.append(length)
        assert sum(window) == level + length
        if level + length < 20:
            bins.put(level + length, window)
