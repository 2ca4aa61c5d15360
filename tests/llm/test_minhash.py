import random

import brute
import numpy as np
from conftest import SF, table
from stocklake.llm import minhash


def check(df, rows):
    want = brute.near_duplicates([(d, t) for d, t, *_ in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == want


def edited(words, rng, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_edges(documents):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\vtwo"), (6, "one two three four five")]
    rows += [(7, "x " * 30_000), (8, "x x x x x"), (9, "é a b c d"), (10, "É a b c d")]
    df = documents(rows)
    check(df, rows)
    assert table(minhash.near_duplicates(df).where("kept"), "doc_id") == [(i,) for i in (1, 10, 2, 3, 4, 6, 7, 9)]


def test_chain_of_copies_is_one_group(documents):
    """Each text is near the next only, so most links lead past the least member."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(12):
        rows.append((100 - i, " ".join(words)))
        words[i * 20 : i * 20 + 12] = [f"n{i}-{k}" for k in range(12)]
    rows += [(200 + i, " ".join(rng.choices([f"z{k}" for k in range(500)], k=80))) for i in range(20)]
    check(documents(rows, clashing=False), rows)
    found = brute.near_duplicates(rows)
    assert {found[100 - i][1] for i in range(12)} == {89}


def test_many_near_copies(documents):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, edited(base, rng, 3)) for i in range(150)] + [(500 + i, " ".join(base)) for i in range(50)]
    rows += [(900, None), (901, " ".join(base[:60]))]
    check(documents(rows, clashing=False), rows)


def test_null_and_empty(documents):
    rows = [(None, "a b c d e f"), (1, "a b c d e f")]
    got = table(minhash.near_duplicates(documents(rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted([(None, 2, None, True), (1, 2, 1, True)], key=repr)
    assert minhash.near_duplicates(documents(rows).limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[500:2500]  # 1500 of 2500
    made = minhash.superminhash([a, b, a[:3], a], 128)
    assert abs((made[0] == made[1]).mean() - 0.6) < 0.2
    assert (made[0] == made[3]).all()


def test_large_set_is_signed_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    found = rng.integers(0, 2**63, 1000).astype(np.uint64)
    whole = minhash.superminhash([found], 32)
    monkeypatch.setattr(minhash, "ELEMENTS", 64)
    assert (minhash.superminhash([found], 32) == whole).all()


def test_blocks_of_one_bucket_meet(spark, monkeypatch):
    """Members within and across blocks of an unsettled bucket all come together."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    found = np.arange(20, dtype=np.uint64)
    signature = minhash.superminhash([found], 4)[0].tobytes()
    rows = [(1, 0, doc, doc, found.tobytes(), signature) for doc in range(10)]
    schema = "key long, band int, doc long, component long, shingles binary, signature binary"
    links = table(minhash._cross_links(spark.createDataFrame(rows, schema), 4, 75), "a", "b")
    parent = list(range(10))
    for a, b in links:
        parent = [parent[a] if p == parent[b] else p for p in parent]
    assert len(set(parent)) == 1


def test_each_pair_is_compared_in_its_first_band():
    sets = [np.arange(k, k + 40, dtype=np.uint64) for k in (0, 2, 4, 300)]
    signatures = minhash.superminhash(sets, 32)
    first = (signatures[0] == signatures[1]).reshape(8, 4).all(axis=1).argmax()
    args = np.arange(4), np.arange(4), np.zeros(4), sets, signatures
    links = [minhash.linked_pairs(*args, band, 4, 75) for band in range(8)]
    assert [(0, 1) in found for found in links] == [band == first for band in range(8)]
    assert all(3 not in pair for found in links for pair in found)
