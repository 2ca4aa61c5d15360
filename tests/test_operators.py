import itertools
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stocklake.operators import (
    absent_from,
    append_new,
    append_snapshot,
    assign_keys,
    bucketed_keys,
    clean_rows,
    constraints,
    denormalise,
    explode_distinct,
    explode_structs_outer,
    exploded_counts,
    fanout_counts,
    fk_violations,
    halve_minutes,
    insert_ignore,
    label_windows,
    latest_by,
    latest_versions,
    length_violations,
    lookup,
    not_in,
    not_null_violations,
    range_violations,
    split_explode,
    stage_marked,
    table_counts,
    unique_violations,
    within_bounds,
)


def test_clean_rows(spark, rows):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("a", " "), ("a", "\u00a0"), (None, "x"), ("b", " y ")],
        "k STRING, v STRING",
    )
    assert rows(clean_rows(df)) == [("a", "x"), ("b", " y ")]
    assert rows(clean_rows(df, required=["k"])) == [("a", "x"), ("a", None), ("b", " y ")]


def test_split_explode_keeps_spaces_and_empties(spark, rows):
    df = spark.createDataFrame(
        [(1, "A, B"), (2, "A"), (3, "Londoncd "), (4, "A, "), (5, "a.b|c"), (6, None)],
        "id INT, names STRING",
    )
    assert rows(split_explode(df, "names", ", ", out="name")) == [
        (1, "A"), (1, "B"), (2, "A"), (3, "Londoncd "), (4, ""), (4, "A"), (5, "a.b|c"), (6, None),
    ]
    assert rows(split_explode(df.where("id = 5"), "names", "|")) == [(5, "a.b"), (5, "c")]


ARTICLE = "id INT, tickers ARRAY<STRUCT<t: STRING>>, topics ARRAY<STRUCT<p: STRING>>"


def test_explode_structs_outer_keeps_empty(spark, rows):
    df = spark.createDataFrame([(1, None, []), (2, [], None), (3, [("a",)], [])], ARTICLE)
    exploded = explode_structs_outer(df.drop("topics"), "tickers", {"t": "ticker"})
    assert rows(exploded) == [(1, None), (2, None), (3, "a")]


def test_explode_distinct_equals_distinct_of_explode(spark, rows):
    rng = random.Random(7)

    def items(letters):
        return [(x,) for x in letters if rng.random() < 0.5] or None

    # A third of all rows share one identity; some are whole copies.
    data = [
        (rng.choice([0, 0, 0, *range(1, 8)]), items("abc"), items("xy")) for _ in range(300)
    ]
    df = spark.createDataFrame(data + data[:30], ARTICLE)
    arrays = {"tickers": {"t": "ticker"}, "topics": {"p": "topic"}}
    split = explode_distinct(stage_marked(df, arrays, "rows"), arrays)
    expected = {
        (i, t, p)
        for i, ts, ps in data
        for (t,), (p,) in itertools.product(ts or [(None,)], ps or [(None,)])
    }
    assert rows(split) == sorted(expected, key=repr)
    # The counts of the same rows, without them; hashes stand for the other columns.
    kept = df.withColumn("other", F.col("id") * 2)
    marked = stage_marked(kept, arrays, "counted", keep=["id"])
    per_id, per_topic = exploded_counts(marked.fillna(0), arrays, ["id"], [None, "topics"])
    want, by_topic = Counter(i for i, _, _ in expected), Counter((i, p) for i, _, p in expected)
    filled = {i for i, t, p in expected if t is None or p is None}
    counted = {r.id: r.n for r in per_id.groupBy("id").agg(F.sum("copies").alias("n")).collect()}
    assert {i: n for i, n in counted.items() if i not in filled} == {i: n for i, n in want.items() if i not in filled}
    got = {(r.id, r.topic): r.n for r in per_topic.groupBy("id", "topic").agg(F.sum("copies").alias("n")).collect()}
    assert {k: n for k, n in got.items() if k[0] not in filled} == {k: n for k, n in by_topic.items() if k[0] not in filled}


def test_windows_against_brute_force(spark):
    rng = random.Random(3)
    cap, data = 20, []
    # Below, at and above the cap; one half, one hour, one minute alone above it.
    for day, n, hours in ((1, 19, 24), (2, 20, 24), (3, 90, 24), (4, 25, 6), (5, 45, 13), (6, 90, 2)):
        for _ in range(n):
            hour, minute = rng.randrange(hours), rng.choice([0, 0, 1, 30])
            data.append((len(data), f"2024-01-0{day} {hour:02}:{minute:02}:07"))
    data.append((len(data), None))
    df = spark.createDataFrame(data, "id INT, at STRING").select(
        "id", F.col("at").cast("timestamp").alias("ts")
    )
    got = {r.id: (r.time_zone, r.window_start) for r in label_windows(df, "ts", cap).collect()}

    def windows(at):
        half = (2, at[:10] + " 00:00") if at[11:16] <= "12:00" else (3, at[:10] + " 12:01")
        return [(1, at[:10] + " 00:00")], [half], [(4, at[:13] + ":00")], [(5, at[:16])]

    expected = {len(data) - 1: (None, None)}
    by_day = {}
    for i, at in data[:-1]:
        by_day.setdefault(at[:10], []).append((i, at))
    for feed in by_day.values():
        for level in range(4):
            labels = {i: windows(at)[level][0] for i, at in feed}
            if level == 3 or max(Counter(labels.values()).values()) < cap:
                break
        expected.update(labels)
    assert {i: (z, s and f"{s:%Y-%m-%d %H:%M}") for i, (z, s) in got.items()} == expected
    assert {z for z, _ in got.values()} == {None, 1, 2, 3, 4, 5}


def test_bucket_without_numbers_left_is_an_error(spark):
    df = spark.range(3).select(F.lit(1).alias("n"))
    with pytest.raises(Exception, match="no numbers left"):
        bucketed_keys(df, ["n"], "k", prefix=7, buckets=1 << 40).where("k is null or k > 0").collect()



def test_lookup_and_denormalise(spark, rows):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id INT, ex INT")
    exchange = spark.createDataFrame([(10, "NYSE", 5)], "key INT, name STRING, region INT")
    region = spark.createDataFrame([(5, "US")], "key INT, place STRING")
    assert rows(lookup(fact, exchange, {"ex": "key"}, ["name"], "inner")) == [(1, 10, "NYSE")]
    chain = [(exchange, {"ex": "key"}, ["name", "region"]), (region, {"region": "key"}, ["place"])]
    assert rows(denormalise(fact, chain), "id", "name", "place") == [
        (1, "NYSE", "US"), (2, None, None), (3, None, None),
    ]


@pytest.mark.parametrize(
    "known,expected",
    [
        (["a"], ["b"]),
        (["a", None], []),
        ([None], []),
        ([], ["a", "b", None]),
    ],
)
def test_not_in_follows_sql_for_nulls(spark, known, expected):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v STRING")
    other = spark.createDataFrame([(k,) for k in known], "v STRING")
    df.createOrReplaceTempView("df")
    other.createOrReplaceTempView("other")
    sql = spark.sql("select v from df where v not in (select v from other)")
    got = [r.v for r in not_in(df, other, "v").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sorted(got, key=str) == sorted([r.v for r in sql.collect()], key=str)


def test_absent_from_keeps_null_keys(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    assert rows(absent_from(df, spark.createDataFrame([(1,), (None,)], "k INT"), "k")) == [
        (2,), (None,),
    ]


def test_within_bounds(spark, rows):
    target = spark.createDataFrame([("a",), ("c",), ("e",), ("n/a",), (None,)], "k STRING")
    batch = spark.createDataFrame([("b",), ("e",)], "k STRING")
    assert rows(within_bounds(target, batch, "k")) == [("c",), ("e",)]
    assert rows(within_bounds(target, batch.limit(0), "k")) == []
    assert ("a",) not in rows(within_bounds(target, batch, "k"))
    assert rows(within_bounds(target, batch, "k", stand_in="a")) == [("a",), ("c",), ("e",)]


def test_fanout_counts_equal_the_join(spark, rows):
    rng = random.Random(5)
    left = [(rng.choice("aaab"), rng.randrange(3)) for _ in range(60)]
    right = [(rng.choice("aaabc"),) for _ in range(50)]
    facts = spark.createDataFrame(left, "title STRING, v INT")
    dims = spark.createDataFrame(right, "title STRING")
    joined = facts.join(dims, "title").groupBy("title", "v").count()
    assert rows(fanout_counts(facts, dims, ["title"], "n")) == rows(joined)


def test_assign_keys_are_dense_and_ordered(spark):
    names = [f"n{i:04}" for i in range(1000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n, n[-1]) for n in names], "name STRING, v STRING")
    keyed = assign_keys(df.repartition(7), ["name"], "key", start=100)
    assert keyed.columns == ["key", "name", "v"]
    got = [(r.key, r.name) for r in keyed.collect()]
    assert sorted(got) == [(101 + i, f"n{i:04}") for i in range(1000)]
    assert assign_keys(df.limit(0), ["name"], "key").count() == 0


def test_assign_keys_settle_ties_by_the_rest(spark):
    df = spark.createDataFrame([("same", i) for i in range(200)], "name STRING, v INT")
    first, second = (
        {r.v: r.key for r in assign_keys(df.repartition(n), ["name"], "key").collect()}
        for n in (2, 9)
    )
    assert first == second
    assert sorted(first.values()) == list(range(1, 201))


def test_bucketed_keys_are_unique_and_repeatable(spark):
    df = spark.range(5000).select((F.col("id") / 3).cast("int").alias("a"), F.col("id").alias("b"))
    one, two = (
        {r.b: r.key for r in bucketed_keys(d, ["a", "b"], "key", prefix=3, buckets=16).collect()}
        for d in (df.repartition(3), df.repartition(11))
    )
    assert one == two
    assert len(set(one.values())) == 5000
    assert {key >> 40 for key in one.values()} == {3}


def test_latest(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 10, "x"), ("a", 2, 11, "y"), ("a", 2, 12, "z"), ("b", None, 1, "n"), (None, 1, 1, "q")],
        "ticker STRING, at INT, key INT, name STRING",
    )
    expected = [("a", 2, 12, "z"), ("b", None, 1, "n"), (None, 1, 1, "q")]
    assert rows(latest_by(df, ["ticker"], ["at", "key"])) == expected
    assert rows(latest_versions(df, ["ticker"], ["at", "key"])) == expected
    assert len(rows(latest_versions(df, ["ticker"], ["at", "key"], n=2))) == 4


def test_latest_versions_of_a_hot_key(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("k"), "id")
    newest = latest_versions(df, ["k"], ["id"], n=5).where("k = -1")
    assert sorted(r.id for r in newest.collect()) == [29985, 29988, 29991, 29994, 29997]


def test_insert_ignore(spark, rows):
    target = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    new = spark.createDataFrame(
        [("a", 9), ("b", 3), ("b", 2), ("c", 5), (None, 7), (None, 8)], "k STRING, v INT"
    )
    assert rows(insert_ignore(new, target, ["k"], ["v"])) == [
        ("b", 2), ("c", 5), (None, 7), (None, 8),
    ]
    keys_only = insert_ignore(new.select("k"), target, ["k"], [])
    assert rows(keys_only) == [("b",), ("c",), (None,), (None,)]


def test_append_snapshot_continues_the_keys(spark, rows):
    target = spark.createDataFrame([(7, "old", "d")], "key BIGINT, name STRING, note STRING")
    df = spark.createDataFrame([("b",), ("a",)], "name STRING")
    added = append_snapshot(df, target, "key", ["name"], {"note": F.lit("n")})
    assert rows(added) == [(8, "a", "n"), (9, "b", "n")]


def test_violations(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 2**31), (1, "b", 5), (2, None, -(2**31) - 1), (None, "long", None), (None, None, 0)],
        "k INT, v STRING, n BIGINT",
    )
    parent = spark.createDataFrame([(1,), (None,)], "pk INT")
    assert rows(unique_violations(df, ["k"])) == [(1, 2)]
    assert rows(fk_violations(df, parent, "k", "pk"), "k") == [(2,)]
    assert rows(not_null_violations(df, ["k", "v", "n"])) == [("k", 2), ("n", 1), ("v", 2)]
    assert rows(not_null_violations(df.limit(1), ["k", "v"])) == []
    assert rows(range_violations(df, "n", -(2**31), 2**31 - 1), "k") == [(1,), (2,)]
    assert rows(length_violations(df, "v", 3), "v") == [("long",)]
    assert rows(table_counts({"x": df, "y": df.limit(0)})) == [("x", 5), ("y", 0)]


def test_cleaning_and_splitting_agree_with_pandas(spark):
    rng = random.Random(11)
    pool = ["", " ", "\t", "\u00a0", "a", " a", "a, b", "b,", ", ", "a, b, a", None, "\n\x1f"]
    data = [(rng.choice(pool), rng.choice(pool)) for _ in range(2000)]
    frame = pd.DataFrame(data, columns=["k", "v"])
    kept = frame.replace(r"^\s*$", np.nan, regex=True).drop_duplicates().dropna()
    pieces = kept.assign(v=kept["v"].str.split(", ")).explode("v")

    cleaned = clean_rows(spark.createDataFrame(data, "k STRING, v STRING"))
    assert sorted(map(tuple, cleaned.collect())) == sorted(map(tuple, kept.values))
    exploded = split_explode(cleaned, "v")
    assert sorted(map(tuple, exploded.collect())) == sorted(map(tuple, pieces.values))


def test_constraints_in_one_pass(spark, rows):
    """Every kind of rule, with keys of different types, nulls and a hot key."""
    parent = spark.createDataFrame([(n, f"p{n}") for n in range(5)] + [(None, "none")], "id INT, name STRING")
    child = [(n, None if n % 7 == 0 else n % 6, "hot" if n % 3 else f"k{n}", 2**31 * (n % 2)) for n in range(60)]
    child = spark.createDataFrame(child, "n BIGINT, parent BIGINT, key STRING, size BIGINT")
    rules = [
        constraints.reference("child", "parent", "parent", "id"),
        constraints.reference("child", "n", "child", "size"),
        constraints.unique("child", ["key"]),
        constraints.unique("child", ["n"]),
        constraints.unique("child", ["parent", "key"]),
        constraints.not_null("child", "parent"),
        constraints.not_null("parent", "name"),
        constraints.longest("child", "key", 2),
        constraints.within("child", "size", 0, 2**31 - 1),
    ]
    tables = {"parent": parent, "child": child, "unused": child}
    data = child.collect()
    pairs = Counter((r.parent, r.key) for r in data if r.parent is not None)
    want = [
        ("child", "integer size", 30),
        ("child", "length of key", sum(len(r.key) > 2 for r in data)),
        ("child", "n in child", 59),
        ("child", "not null parent", 9),
        ("child", "parent in parent", sum(r.parent == 5 for r in data)),
        ("child", "unique key", 1),
        ("child", "unique parent, key", sum(n > 1 for n in pairs.values())),
    ]
    report = constraints.report(tables, rules)
    plan = report._jdf.queryExecution().executedPlan().toString()
    # Each table is read once, and nothing is joined.
    assert plan.count("Scan ") == 2 and "Join" not in plan
    assert rows(report) == want
    assert constraints.report({"child": child.limit(0), "parent": parent}, rules).count() == 0


def test_halved_minutes_against_brute_force(spark):
    """Equal times, neighbours one microsecond apart, and minutes below the cap."""
    rng = random.Random(9)
    cap, data = 4, []
    for minute, n, spread in ((0, 3, 60_000_000), (1, 40, 60_000_000), (2, 60, 50), (3, 9, 1), (4, 4, 60_000_000)):
        data += [minute * 60_000_000 + 30_000_000 * (spread < 100) + rng.randrange(spread) for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(data)), "id INT, micros BIGINT").select(
        "id", F.timestamp_micros("micros").alias("ts")
    )
    got = halve_minutes(df, "ts", cap).select("id", "time_zone", F.unix_micros("window_start").alias("at"), "halvings")
    rows = {r.id: r for r in got.collect()}
    assert len(rows) == len(data)
    for i, micros in enumerate(data):
        minute, at = divmod(micros, 60_000_000)
        own = [m % 60_000_000 for m in data if m // 60_000_000 == minute]
        level = 0
        while level < 26 and sum(m * 2**level // 60_000_000 == at * 2**level // 60_000_000 for m in own) >= cap:
            level += 1
        start = minute * 60_000_000 - (-(at * 2**level // 60_000_000) * 60_000_000 // 2**level)
        assert (rows[i].time_zone, rows[i].at, rows[i].halvings) == (6 if level else 5, start, level)


def test_halved_minutes_repeat_no_row_per_level(spark):
    """Shuffled rows follow the events, not the 27 levels of a minute."""
    micros = (F.col("id") % 90 * 1_000_000).alias("micros")
    df = spark.range(9000).select("id", F.timestamp_micros(micros).alias("ts"))
    halved = halve_minutes(df, "ts", 3)
    assert "sequence(0, 26" not in halved._jdf.queryExecution().optimizedPlan().toString()
    # A hundred rows at each time: no part of a minute is small enough.
    assert {tuple(r) for r in halved.select("time_zone", "halvings").distinct().collect()} == {(6, 26)}
    assert halved.count() == 9000


def test_append_new_numbers_the_first_of_each_key(spark, rows):
    """Ten versions a key, known keys, keys with a null: as insert_ignore, then append_snapshot."""
    data = [(k, n * 7 % 10, f"t{n}") for k in ["b", "a", "c", None] for n in range(10)]
    new = spark.createDataFrame(data, "k STRING, n INT, t STRING")
    target = spark.createDataFrame([(5, "c", 0, "old", "x")], "key BIGINT, k STRING, n INT, t STRING, at STRING")
    at = {"at": F.lit("now")}
    got = rows(append_new(new, target, target, "key", ["k"], ["n"], at))
    want = rows(append_snapshot(insert_ignore(new, target, ["k"], ["n", "t"]), target, "key", ["k"], at))
    assert {r[0] for r in got} == {r[0] for r in want} == set(range(6, 18))
    assert [r for r in got if r[1]] == [r for r in want if r[1]] == [(16, "a", 0, "t0", "now"), (17, "b", 0, "t0", "now")]
    # Rows without a key are all kept; they come first.
    assert {r[1:] for r in got if not r[1]} == {r[1:] for r in want if not r[1]} and len(got) == 12
