import datetime
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stocklake import schemas
from stocklake.session import shared_dir, staging_path
from stocklake.sources import (
    candle_envelope,
    candles_from_text,
    export_all,
    export_rows,
    import_raw_candles,
    latest_file,
    merge_fetches,
    read_json_array,
    read_json_lines,
    read_latest_json_array,
    read_partition,
    read_split_array,
    rejected_payloads,
    union_sources,
    unnest_envelope,
    write_days,
    write_json_array,
    write_json_lines,
    write_partition,
)
from stocklake.sources.jdbc import jdbc_options

DAY = datetime.date(2025, 9, 15)


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, 'q"\n')], "id INT, v STRING")


def test_pretty_json_array(spark, tmp_path, rows):
    path = tmp_path / "crawl.json"
    path.write_text(json.dumps([{"id": 1, "v": "a", "extra": 0}, {"id": 2}], indent=4))
    schema = "id INT, v STRING"
    assert rows(read_json_array(spark, str(path), schema)) == [(1, "a"), (2, None)]


TRICKY = ["", "}", "a } b", '\\"}', "[{", "]", "\\\\", '\\\\"', "\n},\n{", "ä}€", "x" * 90, '"' * 5 + "{", "}}]"]


@pytest.fixture
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "150")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("indent", [None, 2])
def test_split_documents_equal_whole_ones(spark, tmp_path, rows, tiny_splits, indent):
    schema = "id INT, v STRING, more ARRAY<STRUCT<k: STRING, z: STRUCT<n: INT>>>, gone INT"
    for number in range(3):
        records = [
            {"id": 100 * number + i, "v": v, "more": [{"k": TRICKY[-i % 13], "z": {"n": i}}] * (i % 3), "extra": {v: {}}}
            for i, v in enumerate(TRICKY * (number + 1))
        ]
        (tmp_path / f"{number}.json").write_text(json.dumps(records, indent=indent, ensure_ascii=number == 1))
    (tmp_path / "none.json").write_text(" [ ] \n")
    (tmp_path / "empty.json").write_text("")
    got = read_split_array(spark, str(tmp_path), schema)
    assert rows(got) == rows(read_json_array(spark, str(tmp_path), schema))
    assert got.count() == 6 * len(TRICKY)


def test_split_document_is_read_by_many_tasks(spark, tmp_path, tiny_splits):
    (tmp_path / "x.json").write_text(json.dumps([{"id": i} for i in range(500)]))
    read = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert read.rdd.getNumPartitions() > 20
    assert read_split_array(spark, str(tmp_path), "id INT").agg(F.sum("id")).first()[0] == 500 * 499 // 2


@pytest.mark.parametrize(
    "text",
    ['[{"id": 1}, {"id": 2}', '[{"id": 1}, {"id"', '[{"id": 1}] {"id": 2}', '[{"id": 1} {"id": 2}]', '{"error": {}}',
     '[1, {"id": 1}]', '[{"id": 1}, 2]', '[{"id": "]}]', '[{"id": x}]'],
)
def test_broken_split_documents_are_an_error(spark, tmp_path, tiny_splits, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="no array of objects|MALFORMED_RECORD"):
        read_split_array(spark, str(tmp_path), "id INT").collect()


def test_json_roundtrips(spark, tmp_path, rows, pairs):
    for write, read in (
        (write_json_lines, read_json_lines),
        (write_json_array, lambda s, p, t: read_json_array(s, p, t, one_document_per_line=True)),
    ):
        for _ in range(2):
            write(pairs, str(tmp_path / "out"))
        assert rows(read(spark, str(tmp_path / "out"), pairs.schema)) == rows(pairs)


def test_json_lines_skip_blank_lines(spark, tmp_path, rows):
    (tmp_path / "x.json").write_text('{"id": 1}\n\n  \n{"id": 2}\n')
    assert rows(read_json_lines(spark, str(tmp_path), "id INT")) == [(1,), (2,)]


def test_latest_file_by_time_and_extension(spark, tmp_path):
    for name, when in (("b.json", 300), ("a.json", 500), ("z.txt", 900), ("c.json", 100)):
        (tmp_path / name).write_text(json.dumps([{"name": name}]))
        os.utime(tmp_path / name, (when, when))
    assert latest_file(spark, str(tmp_path)).first().path.endswith("/a.json")
    assert latest_file(spark, str(tmp_path), "csv").first().path is None
    assert read_latest_json_array(spark, str(tmp_path), "name STRING").first().name == "a.json"
    empty = tmp_path / "empty"
    empty.mkdir()
    schema = schemas.MARKETS
    with pytest.raises(FileNotFoundError):
        read_latest_json_array(spark, str(empty), schema)
    assert read_latest_json_array(spark, str(empty), schema, missing_ok=True).count() == 0


def test_latest_file_reads_no_content(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    plan = latest_file(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp>" in plan


def test_partition_is_replaced_alone(spark, tmp_path, rows, pairs):
    root = str(tmp_path)
    write_partition(pairs, root, DAY)
    write_partition(pairs.limit(1), root, "2025-09-16")
    write_partition(pairs.where("id = 2"), root, "2025-09-15")
    day = read_partition(spark, root, DAY, pairs.schema)
    assert rows(day) == [(2, None, DAY)]
    assert rows(read_partition(spark, root, "2025-09-16", pairs.schema), "id") == [(1,)]
    write_partition(pairs.limit(0), root, DAY)
    assert rows(read_partition(spark, root, DAY, pairs.schema)) == []


def test_missing_day(spark, tmp_path, pairs):
    write_partition(pairs, str(tmp_path), DAY)
    with pytest.raises(AnalysisException):
        read_partition(spark, str(tmp_path), "2025-01-01", pairs.schema)
    none = read_partition(spark, str(tmp_path), "2025-01-01", pairs.schema, missing_ok=True)
    assert none.columns == ["id", "v", "dt"] and none.count() == 0


def test_write_days_replaces_the_days_given(spark, tmp_path, rows):
    def days(*values):
        return spark.createDataFrame(values, "id INT, dt STRING").withColumn(
            "dt", F.col("dt").cast("date")
        )

    root = str(tmp_path / "t")
    write_days(days((1, "2025-09-15"), (2, "2025-09-16")), root)
    write_days(days((9, "2025-09-16"), (3, "2025-09-17")), root)
    assert rows(spark.read.parquet(root), "id") == [(1,), (3,), (9,)]


def test_unnest_envelope(spark, rows):
    texts = ['{"feed": [{"title": "a"}, {"title": "b"}]}', '{"feed": []}', '{"error": 1}']
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    with pytest.raises(Exception, match="no array 'feed'"):
        unnest_envelope(df, "feed", schemas.NEWS_ENVELOPE).collect()
    feed = unnest_envelope(df, "feed", schemas.NEWS_ENVELOPE, skip_rejected=True)
    assert feed.columns == schemas.NEWS.names
    assert rows(feed, "title") == [("a",), ("b",)]
    structs = spark.createDataFrame([([(1, "x")],), (None,)], "results ARRAY<STRUCT<a: INT, b: STRING>>")
    assert rows(unnest_envelope(structs, "results", skip_rejected=True)) == [(1, "x")]
    with pytest.raises(Exception, match="no array 'results'"):
        unnest_envelope(structs, "results").collect()


def test_rejected_payloads(spark, rows):
    texts = ['{"results": [{"T": "A", "t": 1}, {"T": "B"', '{"error": "limit reached"}', "", "[1]"]
    texts += ['{"results": []}', '{"results": [{"T": "A", "t": 1}]}', '{"results": null}']
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    counts = dict(rows(rejected_payloads(df, "results", candle_envelope())))
    assert counts["no array"] >= 2 and sum(counts.values()) == 5
    assert rows(candles_from_text(df, skip_rejected=True), "ticker") == [("A",)]
    for text in texts[:2]:
        with pytest.raises(Exception, match="no array 'results'"):
            candles_from_text(df.where(F.col("value") == text)).collect()


def test_broken_records_are_an_error(spark, tmp_path, rows):
    (tmp_path / "x.json").write_text('{"id": 1}\n{"id": 2\n{"id": 3}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_lines(spark, str(tmp_path), "id INT").collect()
    assert rows(read_json_lines(spark, str(tmp_path), "id INT", skip_broken=True)) == [(1,), (3,)]


def test_candle_text_with_both_cases(spark, rows):
    text = '{"results": [{"T": "AAA", "t": 5, "v": 1.5, "otc": true}, {"T": "B", "t": 6}]}'
    df = candles_from_text(spark.createDataFrame([(text,)], "value STRING"))
    assert df.schema == schemas.CANDLES
    assert rows(df, "ticker", "t", "v", "otc") == [("AAA", 5, 1.5, True), ("B", 6, None, None)]


def test_import_of_parquet_with_both_cases(spark, tmp_path, rows):
    raw = tmp_path / "raw" / "dt=2025-09-15"
    raw.mkdir(parents=True)
    # A day without OTC listings has no otc column at all.
    columns = {c: [1.0] for c in ("v", "vw", "o", "c", "h", "l")}
    pq.write_table(pa.table({"T": [" A "], **columns, "t": [7], "n": [2]}), raw / "p.parquet")
    import_raw_candles(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), DAY)
    bronze = read_partition(spark, str(tmp_path / "bronze"), DAY, schemas.CANDLES)
    assert rows(bronze, "ticker", "t", "n", "otc") == [(" A ", 7, 2, None)]
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_union_matches_names(spark, rows):
    one = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    two = spark.createDataFrame([("a", 1)], "v STRING, k INT")
    assert rows(union_sources(one, two)) == [(1, "a"), (1, "a")]


def test_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, DAY, None, [0.5])], "time_key INT, time_date DATE, note STRING, a ARRAY<DOUBLE>"
    )
    expected = {
        "a": [0.5], "note": None, "time_date": "Mon, 15 Sep 2025 00:00:00 GMT", "time_key": 1,
    }
    row = export_rows(df).first().json_row
    assert json.loads(row) == expected and list(json.loads(row)) == sorted(expected)
    export_all({"t": df}, str(tmp_path))
    assert json.loads(spark.read.text(f"{tmp_path}/t").first().value) == expected


def test_jdbc_options():
    assert jdbc_options("jdbc:x", table="t", fetchsize=10) == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "10",
    }
    ranged = jdbc_options(
        "jdbc:x", table="t", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=3
    )
    assert ranged["numPartitions"] == "3" and ranged["lowerBound"] == "0"
    for bad in (
        {},
        {"table": "t", "query": "q"},
        {"table": "t", "num_partitions": 3},
        {"query": "q", "partition_column": "id", "lower_bound": 0, "upper_bound": 9, "num_partitions": 3},
    ):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x", **bad)


class Conf(dict):
    """A session that only has settings."""

    @property
    def conf(self):
        return self


def test_shared_dir_comes_from_the_session():
    assert shared_dir(Conf({"spark.checkpoint.dir": "/shared/x/"})) == "/shared/x"
    assert staging_path(Conf({"spark.checkpoint.dir": "/s"}), "keys").startswith("/s/stocklake/keys-")
    with pytest.raises(ValueError):
        shared_dir(Conf({"spark.master": "yarn"}))


def test_fetches_of_one_day(spark, rows):
    """Newest wins per key, rows of one fetch stay, incomplete payloads stand for nothing."""
    landed = [
        (1, '{"results": [{"k": "a", "v": 1}, {"k": "b", "v": 1}]}'),
        (1, '{"results": [{"k": "c", "v": 1}]}'),
        (2, '{"results": [{"k": "a", "v": 2}, {"k": "d", "v": 2}, {"k": "d", "v": 3}]}'),
        (2, '{"results": []}'),
        (3, '{"results": [{"k": "a", "v": 9}, {"k": "c"'),
        (3, '{"error": "limit"}'),
        (4, None),
    ]
    df = spark.createDataFrame(landed, "fetch INT, value STRING")
    merged = merge_fetches(df, "results", "struct<results: array<struct<k: string, v: int>>>", ["k"])
    assert rows(merged, "fetch", "k", "v") == [(1, "b", 1), (1, "c", 1), (2, "a", 2), (2, "d", 3)]
    assert merge_fetches(df.limit(0), "results", "struct<results: array<struct<k: string, v: int>>>", ["k"]).count() == 0
