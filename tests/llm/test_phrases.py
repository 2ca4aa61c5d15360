"""Phrases against plain counting, and the automata on their own."""

import random
import re
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest
from brute import LOWER
from conftest import SF, table
from stocklake.llm import phrases
from stocklake.llm.phrases import CountTransducer, Settings

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
#: Many shards and ranges out of a small table.
SMALL = Settings(range_bytes=3_000, shard_words=500, united_nodes=200, min_count=3)


def brute(rows, settings=Settings()):
    grams, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                grams[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= settings.min_count}
        for p, a in candidates.items():
            around = [b for q, b in candidates.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])]
            if any(100 * b >= settings.contained * a for b in around):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[: settings.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out, key=repr)


def test_given_documents_in_many_ranges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    settings = replace(SMALL, range_bytes=40_000, shard_words=9_000, united_nodes=20_000)
    assert len(phrases.borders_of(phrases._texts(docs), settings)) > 5
    assert table(phrases.phrases(docs, settings), *COLUMNS) == brute(rows, settings)


def test_edges(spark, documents):
    rows = [(None, "en"), ("", None), ("a b c " * 40, None), ("a b c " * 40, "und"), ("New York. City new\tyork city", "en")] * 4
    rows += [("one two, one two; one two\x0bone two\x0cone\rtwo\nthree", "en")] * 5 + [("x y\x1cz x y\x1cz", "it's\n.")] * 6
    rows += [("ÀB àb ÀB àb", "fr")] * 6 + [("the " * 60_000, "de"), ("only", "xx"), ("", ""), ("p q " * 9, "")]
    rows += [(" ".join(random.Random(n).choices("abcdef", k=90)), "mix") for n in range(20)]
    rows += [("en und en und", "en")] * 7
    df = documents([(n, text, lang) for n, (text, lang) in enumerate(rows)])
    for settings in (SMALL, replace(SMALL, top=3), Settings(min_count=3)):
        assert table(phrases.phrases(df, settings), *COLUMNS) == brute(rows, settings)


def test_empty_table(documents):
    assert phrases.phrases(documents([(1, "a b")]).limit(0)).count() == 0
    assert phrases.phrases(documents([(1, None), (2, "")])).count() == 0


def grams(seed, n=400, words="abcdefg"):
    draw = random.Random(seed)
    out = Counter()
    for _ in range(n):
        out[tuple(w.encode() for w in ("L" + draw.choice("xy"), *draw.choices(words, k=draw.randint(1, 3))))] += draw.randint(1, 3)
    return out


def automaton(counts):
    symbols = sorted({s for path in counts for s in path})
    number = {s: k for k, s in enumerate(symbols)}
    by_length = defaultdict(lambda: ([], []))
    for path, weight in counts.items():
        by_length[len(path)][0].append([number[s] for s in path])
        by_length[len(path)][1].append(weight)
    parts = [(list(np.array(p, np.int64).T), np.array(w, np.int64)) for p, w in by_length.values()]
    return phrases._grown(symbols, parts)


@pytest.mark.parametrize("seed", range(8))
def test_automata_hold_what_they_were_built_of(seed):
    counts = grams(seed)
    built = automaton(counts)
    assert dict(built.rows()) == counts
    assert dict(CountTransducer.unpack(built.pack()).rows()) == counts
    paths = sum(len(level["label"]) for level in built.tree())
    assert sum(len(level["label"]) for level in built.levels) < paths


def test_equal_states_are_one():
    """Two words with the same continuations and counts lead to the same state."""
    counts = {(b"L", a, b, c): 2 for a in (b"p", b"q") for b in (b"r", b"s") for c in (b"t", b"u")}
    built = automaton(counts)
    assert [len(level["start"]) - 1 for level in built.levels] == [1, 1, 1, 1]
    counts[b"L", b"q", b"s", b"u"] = 3
    built = automaton(counts)
    assert [len(level["start"]) - 1 for level in built.levels] == [1, 1, 2, 2]
    assert dict(built.rows()) == counts


@pytest.mark.parametrize("seed", range(8))
def test_ranges_part_the_ngrams(seed):
    counts = grams(seed)
    draw = random.Random(seed)
    known = draw.sample(sorted(counts), 6)
    made = [tuple(bytes([draw.randrange(96, 105)]) for _ in range(draw.randint(1, 4))) for _ in range(4)]
    borders = sorted({*known, *made, (b"Lx",), (b"Lx", b"c"), (b"Lx", b"c", b"c\x00"), (b"M",)})
    whole = automaton(counts)
    parts = dict(phrases.split(whole.symbols, whole.tree(), borders))
    want = defaultdict(dict)
    for path, weight in counts.items():
        want[sum(border <= path for border in borders)][path] = weight
    assert {k: dict(part.rows()) for k, part in parts.items()} == want


@pytest.mark.parametrize("seed", range(8))
def test_union_adds_weights(seed):
    many = [grams(seed * 10 + k, 60, "abcdefghij"[k : k + 5]) for k in range(6)]
    total = sum(many, Counter())
    assert dict(phrases.unite([automaton(c) for c in many]).rows()) == total
    packed = [automaton(c).pack() for c in many]
    assert dict(phrases.united(packed, nodes=50).rows()) == total


@pytest.mark.parametrize("seed", range(8))
def test_composition_looks_up_parts(seed):
    counts, asked = grams(seed), grams(seed + 100, 60, "abcdefghi")
    counting, asking = automaton(counts), automaton(asked)
    answer, meetings = phrases.compose(asking, counting)
    assert dict(answer.rows()) == {path: counts[path] for path in asked if counts[path]}
    assert [len(m) for m in meetings] == [len(level["label"]) for level in asking.tree()]


def test_exact_scores_beyond_64_bits():
    a, left, right = 10**9, 3 * 10**12, 7 * 10**12
    known = {(b"en", b"a"): left, (b"en", b"b"): right}
    assert phrases._score((b"en", b"a", b"b"), a, known)[-1] == 10**24 // (left * right)
    big = np.array([2**62], np.int64)
    assert phrases._reaches(big, big, 50).all()
