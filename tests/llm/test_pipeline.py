import zlib

import brute
import corpus_pipeline
import numpy as np
import pytest
from conftest import SF
from stocklake.llm.queries import tokenizer_path
from tokenizers import Tokenizer


def expected_texts(rows, items):
    """What the pipeline keeps, by plain versions of its stages; all languages are known."""
    rows = [(doc, text) for doc, text in rows if text and any(c.isalpha() for c in text)]
    deduped = brute.line_dedup(rows)
    rows = [(doc, deduped[doc][2]) for doc, _ in rows]
    groups = brute.near_duplicates(rows)
    rows = [(doc, text) for doc, text in rows if groups[doc][1] == doc]
    return {doc: text for doc, text in rows if not brute.contamination(text, items)[1]}


def test_run_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    texts = expected_texts(rows, items)
    pieces = corpus_pipeline.run(spark, SF).toPandas().sort_values(["doc_id", "start"])
    assert set(pieces.doc_id) == set(texts) and len(texts) < len(rows)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for doc, own in pieces.groupby("doc_id"):
        ids = np.array(tokenizer.encode(texts[doc], add_special_tokens=False).ids + [1], "<u4")
        cuts = [zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in own.itertuples()]
        assert own.length.sum() == len(ids) and own.ids_crc32.tolist() == cuts
    filled = pieces.groupby("sequence_id").length.sum()
    assert filled.max() <= 2048


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, documents, name, stage):
    """Nulls, empty and long texts, repeats and clashing columns in any stage."""
    rows = [(1, "plain english words are here", "en"), (1, "plain english words are here", "en"), (2, None)]
    rows += [(3, ""), (4, "12"), (None, "no id but words"), (5, "word " * 30_000, None), (6, "\n\n")]
    df = documents(rows)
    out = stage(spark, df, SF)
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert {1, 5, None} <= kept
    if name != "language":
        assert {2, 3, 4, 6} <= kept
    assert stage(spark, df.limit(0), SF).count() == 0
