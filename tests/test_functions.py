import datetime

from pyspark.sql import functions as F

from stocklake.functions import (
    blank_to_null,
    calendar_columns,
    clamp_scores,
    default_text,
    http_date,
    millis_to_ts,
    null_defaults,
    parse_compact_ts,
    replace_text,
    trim_columns,
)
from stocklake.functions.text import lenient_double


def test_blank_to_null_knows_every_space(spark):
    values = ["", " ", "\t\n", "\u00a0", "\u3000", "\x1c", " a ", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    kept = {r.i: r.v for r in blank_to_null(df).collect()}
    assert kept == {**dict.fromkeys(range(8)), 6: " a "}


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([("  a\t ",)], "v STRING")
    assert trim_columns(df, ["v"]).first().v == "a\t"


def test_default_text_keeps_empty(spark, rows):
    df = spark.createDataFrame([("  ",), (None,), (" x ",)], "v STRING")
    assert rows(default_text(df, ["v"])) == [("",), ("n/a",), ("x",)]


def test_clamp_scores(spark):
    given = ["-0.3", "abc", None, " 1.5 ", "0.25", "", "1e3"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i INT, v STRING")
    scores = [r.v for r in clamp_scores(df, ["v"]).orderBy("i").collect()]
    assert scores == [0.0, 0.0, 0.0, 1.5, 0.25, 0.0, 1000.0]


def test_null_defaults_keep_types(spark):
    df = spark.createDataFrame([(None, None)], "n BIGINT, otc BOOLEAN")
    filled = null_defaults(df, {"n": 0, "otc": False})
    assert filled.schema.simpleString() == "struct<n:bigint,otc:boolean>"
    assert tuple(filled.first()) == (0, False)


def test_replace_text_takes_dots_literally(spark, rows):
    df = spark.createDataFrame([("U.S.A, Texas; U.S.A",), ("UxSxA",)], "v STRING")
    replaced = replace_text(df, "v", r"U\.S\.A", "United States")
    assert rows(replaced) == [("United States, Texas; United States",), ("UxSxA",)]


def test_parse_compact_ts(spark):
    df = spark.createDataFrame([("20250915T093000",), ("bad",), (None,)], "v STRING")
    parsed = [r[0] for r in df.select(parse_compact_ts(F.col("v"))).collect()]
    assert parsed == [datetime.datetime(2025, 9, 15, 9, 30), None, None]


def test_millis_are_cut_towards_zero(spark):
    df = spark.createDataFrame([(1757926800999,), (-1500,), (0,), (None,)], "t BIGINT")
    seconds = df.select(F.unix_micros(millis_to_ts(F.col("t"))))
    assert [r[0] for r in seconds.collect()] == [1757926800000000, -1000000, 0, None]


def test_calendar_and_http_date(spark):
    df = spark.createDataFrame([(datetime.date(2025, 9, 15),)], "time_date DATE")
    row = calendar_columns(df, "time_date").withColumn("h", http_date(F.col("time_date")))
    assert tuple(row.first())[1:] == (
        "Monday",
        "September",
        "3",
        2025,
        "Mon, 15 Sep 2025 00:00:00 GMT",
    )


def test_any_text_is_read_as_a_plain_cast_reads_it(spark, rows):
    texts = ["1", "-0.04", "+2", ".5", "-.5", " 3 ", "1e3", "x", "", "-", ":", "n/a", "NaN", "-Infinity", "1d", "\t4", "~5"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = df.select("t", lenient_double(F.col("t")).cast("string"))
    assert rows(got) == rows(df.select("t", F.col("t").try_cast("double").cast("string")))
