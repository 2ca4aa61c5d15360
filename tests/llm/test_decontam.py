import brute
from conftest import SF
from stocklake.llm import decontam

COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256")


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long")


def check(df, benchmark, rows, items, **options):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in decontam.decontaminate(df, benchmark, **options).collect()}
    known = [(i, t) for i, t in items if i is not None]
    assert got == {d: brute.contamination(t, known) for d, t, *_ in rows}


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    check(df, items, rows, [(r.item_id, r.text) for r in items.collect()])


def test_edges_and_several_tables(spark, documents):
    ten = "one two three four five six seven eight nine ten"
    items = [(1, ten + " eleven twelve"), (2, "Two, THREE"), (3, None), (4, "..."), (None, "four"), (10, "über 7")]
    items += [(2, "nine"), (5, "a a a"), (11, "a b a b a b a b a b a")]
    rows = [(1, None), (2, ""), (3, "--"), (4, ten.upper()), (5, f"x {ten} eleven y"), (6, "Über-7 über 8")]
    rows += [(7, "a a a a b a a a"), (8, "word " * 50_000 + ten), (9, "a b " * 9), (10, "five six " + ten + " " + ten)]
    benchmark = items_of(spark, [(i, t, 9) for i, t in items])
    for limit in (1, 2, 1000):
        check(documents(rows), benchmark, rows, items, table_windows=limit)
    out = decontam.decontaminate(documents(rows), benchmark)
    assert {r.doc_id for r in out.where("contaminated").collect()} == {4, 5, 7, 8, 9, 10}
    assert out.columns.count("n_words") == 1


def test_empty(spark, documents):
    df = documents([(1, "one two"), (1, "one two")])
    assert [r.n_hit for r in decontam.decontaminate(df, items_of(spark, [(1, "x", 1)]).limit(0)).collect()] == [0, 0]
    assert decontam.decontaminate(df.limit(0), items_of(spark, [(1, "x", 1)])).count() == 0


def test_shift_tables_skip(monkeypatch):
    found = decontam.WuManber([(tuple(b"a b c d e f g h i j".split()), 1)])
    table = found.lengths[10]
    assert len(table.shift) == 9 and max(table.shift.values()) == 8 and min(table.shift.values()) == 0
    hit, items = found.search(b"x x x a b c d e f g h i j x".split())
    assert hit.tolist() == [False] * 3 + [True] * 10 + [False] and items == {1}


def test_ids_that_are_no_numbers(spark, documents):
    """Items named by text, in one table and in several."""
    items = [("b-2", "one two three"), ("a,1", "two three four"), ("é", "nine"), ("b-2", "ten")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    rows = [(1, "zero one two three four nine"), (2, "none"), (3, "ten one two three"), (4, None)]
    for limit in (1, 2, 1000):
        check(documents(rows), benchmark, rows, items, table_windows=limit)
