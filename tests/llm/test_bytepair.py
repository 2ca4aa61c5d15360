"""Ids and texts against the library that the vocabulary is written for."""

import hashlib

import pytest
from conftest import SF, table
from hypothesis import given, settings
from hypothesis import strategies as st
from stocklake.llm import bytepair
from stocklake.llm.queries import op11_byte_pairs, tokenizer_path
from tokenizers import Tokenizer

VOCABULARY = tokenizer_path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def codec():
    return bytepair.BytePairCodec(VOCABULARY, bytepair.word_pattern(VOCABULARY))


def test_every_text_of_the_query(spark, library):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = op11_byte_pairs(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(r)[1:] == (len(ids), sha(",".join(map(str, ids))), sha(decoded))


def test_edges(spark, documents, library):
    texts = [None, "", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "don't I'LL 'S 's"]
    texts += ["  two   blanks \n\n end ", "\x1c\x1d\x85\xa0　​", "123,456 ½ ² ٣", "日本語 🙂🙂 👩‍👧", "é́ ß İ ﬁ"]
    texts += ["x" * 100_000, "abcab" * 30_000, "-" * 5_000 + "=" * 5_001, " " * 3_000, "twice", "twice"]
    rows = [(n, text) for n, text in enumerate(texts)] + [(None, "no id"), (1, "")]
    df = documents(rows)
    want = sorted((n, tuple(library.encode(t or "", add_special_tokens=False).ids)) for n, t in rows if n is not None)
    encoded = bytepair.encode(df, VOCABULARY, ["doc_id", "score"])
    got = sorted((r.doc_id, tuple(r.ids)) for r in encoded.collect() if r.doc_id is not None)
    assert got == want
    back = table(bytepair.decode(encoded, VOCABULARY, ["doc_id"]), "doc_id", "text")
    assert back == sorted(((n, t or "") for n, t in rows), key=repr)
    listed = table(bytepair.round_trip(df, VOCABULARY), "doc_id", "n_tokens", "decoded_sha256")
    counts = [(n, len(library.encode(t or "", add_special_tokens=False).ids), sha(t or "")) for n, t in rows]
    assert listed == sorted(counts, key=repr)


def test_empty_table(documents):
    assert bytepair.round_trip(documents([(1, "a")]).limit(0), VOCABULARY).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab .'stl\n0", max_size=200))
def test_any_text(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50_300), max_size=30))
def test_any_ids(codec, library, ids):
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_token_encodes_itself_where_the_library_says_so(codec, library):
    for token, raw in codec.merges.bytes.items():
        alone = [t.id for t in library.model.tokenize(library.model.id_to_token(token) or "")] == [token]
        assert alone == (codec.merges.tokens.get(raw) == token)


def test_shared_prefixes_are_worked_out_once(codec):
    trie = bytepair.PrefixTrie(codec.merges)
    words = [b"inter", b"internal", b"international", b"internet", b"inter"]
    made = dict(trie.encode(words))
    assert len(trie.last) - 1 == len({word[:n] for word in words for n in range(1, len(word) + 1)})
    states = list(trie.last)
    assert dict(trie.encode(reversed(words))) == made and trie.last == states


def test_caches_that_overflow_change_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(bytepair, "NODES", 50)
    monkeypatch.setattr(bytepair, "WORDS_CACHED", 10)
    small = bytepair.BytePairCodec(VOCABULARY, bytepair.word_pattern(VOCABULARY))
    texts = [f"some words number {n} and {n * 7919} others" for n in range(60)]
    for start in range(0, 60, 7):
        part = texts[start : start + 7]
        assert list(small.encode_all(part)) == [library.encode(t, add_special_tokens=False).ids for t in part]


def test_vocabulary_with_a_token_made_twice(tmp_path):
    import json

    content = json.load(open(VOCABULARY, encoding="utf-8"))
    content["model"]["merges"].append(content["model"]["merges"][0])
    (tmp_path / "v.json").write_text(json.dumps(content))
    with pytest.raises(ValueError, match="token twice"):
        bytepair.Merges(str(tmp_path / "v.json"))
