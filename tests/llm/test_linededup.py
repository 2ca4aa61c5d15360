import brute
import pytest
from conftest import table
from stocklake.llm import linededup

LONG = "this line is certainly longer than forty characters"


def check(df, rows):
    want = brute.line_dedup([(d, t) for d, t, *_ in rows])
    got = linededup.dedup_lines(df)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got.collect()} == want
    assert {r.doc_id: r.kept_sha256 for r in got.collect()} == {d: brute.sha(w[2]) for d, w in want.items()}


def test_edges(documents):
    rows = [(i, f"head {i}\n\t {LONG.upper() if i % 2 else LONG}\x0b\n{LONG}\ntail") for i in range(7)]
    rows += [(i, "ä" * 39 + "\n" + "ö" * 40) for i in range(10, 16)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (23, "x\n" * 3000 + LONG + " "), (24, LONG[:39])]
    rows += [(30 + i, "only four documents hold this line of over forty") for i in range(4)]
    df = documents(rows)
    check(df, rows)
    out = linededup.dedup_lines(df)
    assert set(df.columns) < set(out.columns)


def test_line_of_a_third_of_documents(documents):
    rows = [(i, (LONG + "\n" if i % 3 == 0 else "") + f"own line of document number {i} that is long") for i in range(300)]
    check(documents(rows, clashing=False), rows)


def test_null_and_repeated_ids(documents):
    rows = [(None, LONG)] + [(i, LONG) for i in range(4)] + [(3, LONG)]
    got = table(linededup.dedup_lines(documents(rows)), "doc_id", "n_dropped")
    assert got == sorted([(None, 1), (0, 1), (1, 1), (2, 1), (3, 0), (3, 0)], key=repr)


def test_empty(documents):
    assert linededup.dedup_lines(documents([(1, "a")]).limit(0)).count() == 0


def batches_of(spark, runs):
    for batch in range(5):
        rows = [(bytes([k]), 100 - batch) for k in range(batch, batch + 4)]
        yield batch, spark.createDataFrame(rows, "hash binary, doc long")


def test_runs_are_levelled_and_answer_what_is_new(spark):
    runs = linededup.LineRuns(spark, fanout=2, buckets=3)
    for batch, fresh in batches_of(spark, runs):
        unseen = {bytes(r.hash)[0] for r in runs.unseen(fresh).collect()}
        assert unseen == (set(range(4)) if batch == 0 else {batch + 3})
        runs.add(fresh)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    # A hash is in one run, that of its first batch.
    held = [bytes(r.hash)[0] for name in runs.runs() for r in spark.table(name).collect()]
    assert sorted(held) == list(range(8))
    merged = {bytes(r.hash)[0]: (r.docs, r.holder) for r in runs.merged().collect()}
    assert merged == {k: (min(k, 4) - max(k - 3, 0) + 1, 100 - max(k - 3, 0)) for k in range(8)}
    runs.drop()


def test_settled_hashes_are_counted_no_more(spark):
    runs = linededup.LineRuns(spark, fanout=2, buckets=3, min_docs=2)
    for batch in range(6):
        runs.add(spark.createDataFrame([(b"a", 9 - batch), (bytes([batch]), 9 - batch)], "hash binary, doc long"))
    merged = {bytes(r.hash): (r.docs, r.holder) for r in runs.merged().collect()}
    assert merged.pop(b"a") == (2, 9)
    assert merged == {bytes([k]): (1, 9 - k) for k in range(6)}
    runs.drop()


@pytest.mark.parametrize("batches, fanout", [(1, 2), (9, 2)])
def test_any_batches_and_levels(spark, documents, monkeypatch, batches, fanout):
    """Levels beyond the first are reached, and the result is the same."""
    deepest, push = [0], linededup.LineRuns._push
    monkeypatch.setattr(
        linededup.LineRuns, "_push",
        lambda runs, level, name: (deepest.append(level), push(runs, level, name))[1],
    )
    rows = [(i, f"{LONG}{i % 7}\n{LONG}{i % 11}\nown {i}") for i in range(-20, 40)]
    want = brute.line_dedup(rows)
    got = linededup.dedup_lines(documents(rows), batches=batches, fanout=fanout).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got} == want
    assert max(deepest) >= (2 if batches > 1 else 0)


def test_red_without_the_anti_join(documents, monkeypatch):
    """A line of three documents would count as one of five or more."""
    rows = [(i, LONG if i % 3 == 0 else f"own line of document number {i} that is long") for i in range(12)]
    assert sum(r.n_dropped for r in linededup.dedup_lines(documents(rows)).collect()) == 0
    monkeypatch.setattr(linededup.LineRuns, "unseen", lambda runs, keyed: keyed)
    assert sum(r.n_dropped for r in linededup.dedup_lines(documents(rows)).collect()) > 0
