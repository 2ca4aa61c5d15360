import brute
from conftest import SF, table
from pyspark.sql import functions as F
from stocklake.llm import pii

CARD = "4111 1111 1111 1111"


def check(df, rows):
    got = pii.personal_data(df).collect()
    assert len(got) == len(rows)
    want = {doc: brute.base_spans(text or "") for doc, text, *_ in rows}
    for r in got:
        shown = brute.spans_text(want[r.doc_id])
        assert r.base_sha256 == brute.sha(shown), (r.doc_id, want[r.doc_id], r.base)
        assert r.spans.startswith(shown)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[0] == kind for s in want[r.doc_id]) for kind in pii.KINDS
        ]


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_edges(documents):
    texts = [
        None, "", "a@b.c_x@d.e", "a@b@c.d", "x@y", "a.@-.- a@b..c", "@a.b", "é@b.c ü.x@y.z 🙂 1.2.3.4",
        "1.2.3.4.5.6.7.8.9", "256.1.1.1 001.0255.00.0 1.2.3.0000000256", "1.2.3.4567.1.1.1.1", "12.3.4",
        CARD, "4111-1111-1111-1111 5", "4111--1111 1111 1111 1111", "x4111111111111111y", "0" * 16, "0" * 20,
        "5 " + CARD, CARD + "-2", "+1 (743) 555-3824 +12 +1234567 +12345678 +()-.", "++49 30 1234567-",
        "+1 2345678 9012345 6789 +99999999", "+" * 50 + "1" * 9, "1" * 40_000, "a." * 40_000 + "@x.y",
        "1.1." * 20_000, "+1" * 20_000, "a@b.c " * 2_000, "１２３４@b.c 1.2.3.٤",
    ]
    rows = list(enumerate(texts)) + [(None, "n@u.l")]
    check(documents(rows), rows)


def test_repeated_rows_and_empty(documents):
    df = documents([(1, "a@b.c"), (1, "a@b.c"), (1, "other")])
    assert table(pii.personal_data(df), "doc_id", "n_email") == [(1, 0), (1, 1), (1, 1)]
    assert pii.personal_data(df.limit(0)).count() == 0


def test_revealing_terms(documents):
    """A word that occurs with one value only is marked where it occurs with it; one that
    occurs everywhere, too seldom, or by itself elsewhere is not."""
    rows = [(i, f"write to zanzibarius at z@bank.org today {i}") for i in range(4)]
    rows += [(10 + i, f"nothing today to write at number {i}") for i in range(40)]
    rows += [(60, "write to lonely at rare@one.org today")]
    got = {r.doc_id: r for r in pii.personal_data(documents(rows)).collect()}
    for i in range(4):
        assert got[i].spans == "email:24:34,term:9:20"
        assert [t.removed for t in got[i].terms] == [True]
    assert got[60].spans == "email:19:31"
    assert all(got[10 + i].spans == "" for i in range(40))


def test_terms_far_from_the_value(documents):
    """A revealing word counts and is marked in the whole text of a document with the value,
    not in one without; parts of values are no words."""
    filler = "wort " * 100
    rows = [(i, f"x@bank.org {filler}Zanzibarius {filler}zanzibarius") for i in range(4)]
    rows += [(10 + i, f"wort bank org {i}") for i in range(60)] + [(90, f"+123456789 {filler}zanzibarius")]
    texts = dict(rows)
    got = {r.doc_id: r.terms or [] for r in pii.personal_data(documents(rows)).collect()}
    for i in range(4):
        assert [texts[i][t.start : t.end] for t in got[i]] == ["Zanzibarius", "zanzibarius"]
    assert not any(got[i] for i in got if i >= 4)


def test_words_are_placed_exactly(documents):
    """Marked words lie where the text has them, cut words at the window's ends do not count."""
    filler = "wort " * 40
    rows = [(i, f"{filler}ächzend {'b' * 3} x@y.zz, ächzend+1.2.3.4 kwyjibo {filler}") for i in range(5)]
    rows += [(10 + i, "wort bbb") for i in range(60)]
    texts = dict(rows)
    for r in pii.personal_data(documents(rows)).collect():
        for t in r.terms or []:
            assert texts[r.doc_id][t.start : t.end] == t.value and t.value in ("ächzend", "kwyjibo")
        assert r.doc_id >= 10 or len(r.terms) == 3


def test_sanitised(documents):
    rows = [(i, f"write to zanzibarius at z@bank.org or +12345678 today {i}") for i in range(4)]
    rows += [(10 + i, f"nothing today to write at or number {i}") for i in range(60)]
    rows += [(90, None)]
    df = documents(rows)
    texts = {r.doc_id: r.text for r in pii.sanitised(df, pii.personal_data(df)).collect()}
    assert texts[1] == "write to  at [EMAIL] or [PHONE] today 1"
    assert texts[10] == "nothing today to write at or number 0" and texts[90] == ""


def test_native(documents):
    plan = pii.personal_data(documents([(1, "a@b.c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_many_spans_in_one_text(documents):
    """Places are right within blocks, across them, and beyond blocks of blocks."""
    sizes = (0, 1, 31, 32, 33, 1023, 1024, 1025, 50_000)
    rows = [(n, "".join(f"é{i} u{i}@x.yz +1234567{i} " for i in range(n))) for n in sizes]
    for r in pii.personal_data(documents(rows)).collect():
        want = brute.base_spans(dict(rows)[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.spans_text(want))
        assert (r.n_email, r.n_phone) == (r.doc_id, r.doc_id)


def test_sums_before(spark):
    """Sums before each size, of sizes that need all depths."""
    n = 3 * pii.BLOCK**2 + 5
    got = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("long")).alias("s"))
    got = got.select(pii._before(F.col("s"), F.lit(7).cast("long")).alias("b")).first().b
    assert got == [7 + i * (i + 1) // 2 for i in range(n)]


def test_words_of_most_documents_are_no_terms(documents):
    """A word of nearly all documents is dropped by its count, one value in a third of them
    or not; the result is that of judging every pair."""
    rows = [(i, f"often {'x@y.zz' if i % 3 == 0 else 'nothing'} {'sesame' if i % 3 == 0 else ''} {i}") for i in range(60)]
    got = {r.doc_id: [t.value for t in r.terms or []] for r in pii.personal_data(documents(rows)).collect()}
    assert all(got[i] == (["sesame"] if i % 3 == 0 else []) for i in got)
