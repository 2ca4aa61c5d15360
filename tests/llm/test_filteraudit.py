"""Counts of every order and step against a plain walk through the orders."""

import re
from collections import defaultdict
from itertools import permutations

from conftest import SF, table
from stocklake.llm import filteraudit

LABELS = "doc_id long, quality int, toxic int, part string, code int"


def fails(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        out.add("C")
    if re.search("[#$%&*|]", text):
        out.add("D")
    return out


def brute(rows, labels):
    """``(part, order, step): counts`` of ``(doc_id, text, lang)`` rows."""
    texts = [(doc, text or "") for doc, text, _ in rows]
    docs = []
    for doc, text, lang in rows:
        failed = fails(text or "")
        if doc is not None and any(t == (text or "") and d is not None and d < doc for d, t in texts):
            failed.add("E")
        good = any(d == doc and q == 1 for d, q, _ in labels if d is not None)
        toxic = any(d == doc and x == 1 for d, _, x in labels if d is not None)
        docs.append((lang or "", failed, good, toxic))
    out = defaultdict(lambda: [0] * 6)
    shapley = defaultdict(int)
    for order in map("".join, permutations("ABCDE")):
        for part, failed, good, toxic in docs:
            gone = False
            for step, name in enumerate(order, 1):
                here = name in failed and not gone
                again = name in failed and gone
                gone |= here
                add = (not gone, here, again, failed == {name}, here and good, here and toxic)
                out[part, order, step] = [a + b for a, b in zip(out[part, order, step], add, strict=True)]
                shapley[part, name] += here
    return sorted((*key, *counts, shapley[key[0], key[1][key[2] - 1]]) for key, counts in out.items())


def labelled(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], LABELS)


def test_edges(spark, documents):
    long = " ".join(f"w{n}" for n in range(120))
    rows = [(1, long, "en"), (2, long, "en"), (2, long, "en"), (3, long, "de"), (4, None, None), (5, "", ""), (6, "", None)]
    rows += [(7, "A B\x0bC d#", "en"), (8, "same " * 200, "de"), (None, long, "en"), (None, "alone", "en"), (9, "alone", None)]
    rows += [(10, " ".join("ab" for _ in range(150)), "en"), (11, "ÀÉ" * 60 + " " + long, "fr"), (12, "X" * 200_000, "fr")]
    rows += [(13, "Aaaaaaaaa ", "fr"), (13, "another text under the same id", "fr"), (14, "Aaaaaaaa ", "it's")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, 1, 1), (7, None, None), (None, 1, 1), (99, 1, 1)]
    df = documents(rows)
    got = table(filteraudit.audit(df, labelled(spark, labels)), "*")
    assert sorted(got) == brute(rows, labels)


def test_empty_tables(spark, documents):
    none = documents([(1, "a")]).limit(0)
    assert filteraudit.audit(none, labelled(spark, [(1, 1, 1)])).count() == 0
    some = filteraudit.audit(documents([(1, "a")]), labelled(spark, []))
    assert some.count() == 600 and some.agg({"good_lost": "sum"}).first()[0] == 0


def test_fields_do_not_carry():
    """Counts beyond 32 bits in every field of a sum, and back."""
    counters = filteraudit.StepCounters("ABC")
    table_ = counters.outcomes()
    total = sum(n * (1 << 40) * outcome for n, outcome in enumerate(table_, 1))
    counts = counters.unpack(counters.pack(total))
    each = [counters.unpack(counters.pack(outcome)) for outcome in table_]
    assert (counts == sum(n * (1 << 40) * one for n, one in enumerate(each, 1))).all()


def test_parts_beyond_those_held(spark, documents, monkeypatch):
    rows = [(n, f"text {n % 7}", f"lang{n % 11}") for n in range(60)]
    want = brute(rows, [])
    monkeypatch.setattr(filteraudit, "PARTS_HELD", 2)
    monkeypatch.setattr(filteraudit, "TASKS_A_SUM", 1)
    df = documents(rows).repartition(6)
    assert sorted(table(filteraudit.audit(df, labelled(spark, [])), "*")) == want


def test_other_filters(spark, documents):
    """Two filters of one's own, one of which fails copies."""
    filters = {"X": lambda text, words: text.contains("x"), "R": None}
    rows = [(1, "x"), (2, "x"), (3, "y")]
    got = table(filteraudit.audit(documents(rows), labelled(spark, []), filters), "filter_order", "step", "kept", "removed", "redundant", "shapley")
    assert got == [("RX", 1, 2, 1, 0, 1), ("RX", 2, 1, 1, 1, 3), ("XR", 1, 1, 2, 0, 3), ("XR", 2, 1, 0, 1, 1)]


def test_given_documents_count_every_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = filteraudit.audit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    first = rows.where("step = 1 and filter_order = 'ABCDE'").selectExpr("sum(kept + removed)").first()[0]
    assert first == docs.count()
