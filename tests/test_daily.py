"""Whole runs over small payloads with the edge cases real feeds have."""

import datetime
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stocklake import schemas
from stocklake.__main__ import main as command
from stocklake.operators import latest_by
from stocklake.operators.joins import may_match
from stocklake.plans import checks, daily, gold, serving, silver, source_db
from stocklake.sources import append_key_ranges, export_all, read_partition, read_table

RUN = datetime.date(2025, 9, 16)
DAY = datetime.date(2025, 9, 15)

# Sample market records: region, list of exchanges, opening and closing time.
MARKETS = [
    ("United States", "NASDAQ, NYSE, AMEX, BATS", "09:30", "16:15"),
    ("United Kingdom", "Londoncd ", "08:00", "16:30"),
    ("Germany", "XETRA, Berlin, Frankfurt, Munich, Stuttgart", "08:00", "20:00"),
    ("Hong Kong", "Hong Kong", "09:30", "16:00"),
    ("Global", "Global", "00:00", "23:59"),
    ("Global", "Global", "00:00", "23:59"),
    ("Spain", "Barcelona, Madrid", "09:00", "17:30"),
    ("Spain", "Madrid", "08:00", "17:30"),
    (" ", "Nowhere", "09:00", "17:30"),
]
EXCHANGES = {
    ("United States", "NASDAQ"), ("United States", "NYSE"), ("United States", "AMEX"),
    ("United States", "BATS"), ("United Kingdom", "Londoncd "), ("Germany", "XETRA"),
    ("Germany", "Berlin"), ("Germany", "Frankfurt"), ("Germany", "Munich"),
    ("Germany", "Stuttgart"), ("Hong Kong", "Hong Kong"), ("Global", "Global"),
    ("Spain", "Barcelona"), ("Spain", "Madrid"),
}


def market(region, exchanges, opens, closes):
    return {
        "market_type": "Equity", "region": region, "primary_exchanges": exchanges,
        "local_open": opens, "local_close": closes, "current_status": "open", "notes": "",
    }


def company(ticker, **changes):
    return {
        "name": f"{ticker} Inc ", "ticker": ticker, "exchange": "NYSE", "sector": "Tech",
        "industry": "Chips", "sic": "3674", "sicSector": "Manufacturing",
        "sicIndustry": "Semiconductors", "category": "Common", "currency": "USD",
        "location": "Texas; U.S.A", "isDelisted": False, **changes,
    }


COMPANIES = [
    company("AAA"),
    company("AAA"),
    company("AAA", isDelisted=True),
    company("BBB", exchange="NASDAQ", industry="Banks", sector="Finance", sic="6022"),
    company("CCC", exchange="OTC"),
    company("DDD", currency="EUR"),
    company("EEE", sector=" "),
]


def article(title, **changes):
    return {
        "title": title, "url": f"https://x/{title}", "time_published": "20250915T093000",
        "authors": ["Ann"], "summary": " s ", "source": None, "overall_sentiment_score": -0.2,
        "overall_sentiment_label": "Neutral", "banner_image": None,
        "topics": [{"topic": "IPO", "relevance_score": "0.5"}],
        "ticker_sentiment": [
            {"ticker": "AAA", "relevance_score": "0.9", "ticker_sentiment_score": "-0.3",
             "ticker_sentiment_label": "Bearish"}],
        **changes,
    }


def mention(ticker, score="0.1"):
    return {"ticker": ticker, "relevance_score": score, "ticker_sentiment_score": score,
            "ticker_sentiment_label": "Neutral"}


TWO_TOPICS = [{"topic": "IPO", "relevance_score": "1"}, {"topic": "Finance", "relevance_score": "abc"}]
NEWS = [
    article("one"),
    article("one"),
    article("two", topics=TWO_TOPICS,
            ticker_sentiment=[mention("AAA"), mention(" BBB"), mention("ZZZ"), mention("AAA")]),
    article("bare", topics=None, ticker_sentiment=[]),
    article("late", time_published="bad"),
    # Same key as "one", other summary and topics.
    article("one", summary="other", topics=TWO_TOPICS),
]
CANDLES = [
    {"T": "AAA", "v": 10.9, "vw": 1.5, "o": 1, "c": 2, "h": 3, "l": 0.5, "t": 1757966400123, "n": 4},
    {"T": " BBB ", "o": 1, "c": 2, "h": 3, "l": 0.5, "t": -1500, "otc": True, "v": 5e9},
    {"T": " BBB ", "o": 1, "c": 2, "h": 3, "l": 0.5, "t": -1500, "otc": True, "v": 5e9},
    {"T": "ZZZ", "o": 1, "c": 2, "h": 3, "l": 0.5, "t": 1757966400000},
]


def land(root, news=NEWS, candles=CANDLES, companies=COMPANIES, day=DAY):
    documents = {
        f"landing/markets/crawl_{day}.json": [market(*m) for m in MARKETS],
        f"landing/companies/crawl_{day}.json": companies,
        f"landing/news/dt={day}/feed.json": {"items": "n", "feed": news},
        f"landing/ohlcs/dt={day}/day.json": {"results": candles},
    }
    for name, content in documents.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        indent = 4 if isinstance(content, list) else None
        path.write_text(json.dumps(content, indent=indent))


def snapshot(spark, paths, rows):
    return {name: rows(df) for name, df in daily.warehouse_tables(spark, paths).items()}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    land(root)
    paths = daily.Paths(str(root))
    daily.run_all(spark, RUN, paths, "2025-09-16 01:00:00")
    daily.write_news_product(spark, RUN, paths)
    return root, paths


def test_source_tables(spark, run, rows):
    tables = {n: spark.read.parquet(run[1].source(n)) for n in schemas.SOURCE_TABLES}
    regions, exchanges = tables["regions"], tables["exchanges"]
    named = exchanges.join(regions, exchanges.exchange_region_id == regions.region_id)
    assert set(rows(named, "region_name", "exchange_name")) == EXCHANGES
    # The earlier opening time wins for the region listed twice.
    assert ("Spain", "08:00") in rows(regions, "region_name", "region_local_open")
    assert rows(regions, "region_id") == [(i,) for i in range(1, 7)]
    assert rows(tables["companies"], "company_ticker", "company_is_delisted") == [
        ("AAA", False), ("AAA", True), ("BBB", False),
    ]
    assert rows(tables["sic_industries"], "sic_id") == [(3674,), (6022,)]
    assert rows(tables["industries"], "industry_name", "industry_sector") == [
        ("Banks", "Finance"), ("Chips", "Tech"),
    ]


def test_source_load_is_repeatable(spark, run, rows):
    before = {n: rows(spark.read.parquet(run[1].source(n))) for n in schemas.SOURCE_TABLES}
    daily.run_source_db(spark, RUN, run[1], "2025-09-17 01:00:00")
    after = {n: rows(spark.read.parquet(run[1].source(n))) for n in schemas.SOURCE_TABLES}
    assert before == after


def test_warehouse(spark, run, rows):
    tables = daily.warehouse_tables(spark, run[1])
    assert rows(tables["dim_time"]) == [(1, DAY, "Monday", "September", "3", 2025)]
    assert rows(tables["dim_topics"]) == [(1, "Finance"), (2, "IPO"), (3, "n/a")]
    assert rows(
        tables["dim_companies"], "company_key", "company_name", "company_ticker",
        "company_location", "company_exchange_name", "company_region_name",
    ) == [
        (1, "AAA Inc", "AAA", "Texas; United States", "NYSE", "United States"),
        (2, "AAA Inc", "AAA", "Texas; United States", "NYSE", "United States"),
        (3, "BBB Inc", "BBB", "Texas; United States", "NASDAQ", "United States"),
    ]
    published = "2025-09-15 09:30:00"
    assert rows(tables["dim_news"], "news_key", "news_title", "news_time_published", "news_summary") == [
        (1, "bare", published, "s"), (2, "late", "n/a", "s"), (3, "one", published, "other"),
        (4, "two", published, "s"),
    ]
    # Key 2 is the ticker's newest row; volumes may pass the range of an INT.
    assert rows(
        tables["fact_candles"], "candle_company_key", "candle_volume", "candle_volume_weighted",
        "candle_num_of_trades", "candle_is_otc", F.unix_seconds("candle_time_stamp"),
        "candle_time_key",
    ) == [(2, 10, 1.5, 4, False, 1757966400, 1), (3, 5_000_000_000, 0.0, 0, True, -1, 1)]
    assert rows(tables["fact_news_companies"].drop("news_company_key", "dt")) == [
        (2, 2, 0.9, 0.0, "Bearish"), (2, 3, 0.9, 0.0, "Bearish"), (2, 4, 0.1, 0.1, "Neutral"),
        (3, 4, 0.1, 0.1, "Neutral"),
    ]
    assert rows(tables["fact_news_topics"].drop("news_topic_key", "dt")) == [
        (1, 3, 0.0), (2, 2, 0.5), (3, 1, 0.0), (3, 2, 0.5), (3, 2, 1.0), (4, 1, 0.0), (4, 2, 1.0),
    ]


def test_silver_news(spark, run, rows):
    news = read_partition(spark, run[1].silver("news"), DAY, schemas.SILVER_NEWS)
    per_title = dict(rows(news.groupBy("news_title").count()))
    # "one" has 1 x 1 rows of its first form and 1 x 2 of its second.
    assert per_title == {"one": 3, "two": 6, "bare": 1, "late": 1}
    bare = news.where("news_title = 'bare'").drop("dt").first()
    assert bare.news_ticker == "n/a" and bare.topic_name == "n/a"
    assert bare.news_company_relevance_score == 0.0 and bare.news_source == "n/a"
    assert bare.news_overall_sentiment_score == 0.0
    assert news.count() == news.distinct().count()


def test_facts_from_silver_are_those_from_articles(spark, run, rows):
    """Exploding each array by itself gives the facts the product in silver holds."""
    tables = daily.warehouse_tables(spark, run[1])
    news = read_partition(spark, run[1].silver("news"), DAY, schemas.SILVER_NEWS)
    keyed = gold.key_articles(news, tables["dim_news"])
    topics = gold.build_fact_news_topics(keyed, tables["dim_topics"], 1)
    assert rows(topics) == rows(tables["fact_news_topics"].drop("dt"))
    latest = gold.latest_companies(tables["dim_companies"])
    companies = gold.build_fact_news_companies(keyed, latest, 1)
    assert rows(companies) == rows(tables["fact_news_companies"].drop("dt"))


def test_rerun_changes_nothing(spark, run, rows):
    """Not even at another hour of the day."""
    before = snapshot(spark, run[1], rows)
    daily.run_all(spark, RUN, run[1], "2025-09-16 05:00:00")
    assert snapshot(spark, run[1], rows) == before


def test_missing_payloads_are_an_error(spark, tmp_path):
    paths = daily.Paths(str(tmp_path))
    land(tmp_path)
    (tmp_path / "landing/markets/dt=2020-01-01").mkdir()
    for document in (tmp_path / "landing/markets").glob("*.json"):
        document.rename(tmp_path / "landing/markets/dt=2020-01-01" / document.name)
    with pytest.raises(FileNotFoundError):
        daily.run_source_db(spark, RUN, paths, "2025-09-16 01:00:00")
    daily.run_source_db(spark, RUN, paths, "2025-09-16 01:00:00", missing_ok=True)
    with pytest.raises(AnalysisException):
        daily.warehouse_tables(spark, daily.Paths(str(tmp_path / "mistyped")))


def test_error_payload_stops_the_day(spark, tmp_path):
    paths = daily.Paths(str(tmp_path))
    land(tmp_path)
    daily.run_source_db(spark, RUN, paths, "2025-09-16 01:00:00")
    (tmp_path / f"landing/ohlcs/dt={DAY}/more.json").write_text('{"error": "limit reached"}')
    with pytest.raises(Exception, match="no array 'results'"):
        daily.land_bronze(spark, RUN, paths)


def test_command_line(spark, tmp_path, capsys):
    land(tmp_path)
    root = str(tmp_path)
    for job in ("init", "run", "profile", "check"):
        command([job, root, "--date", RUN.isoformat()])
    out = capsys.readouterr().out
    assert "|fact_news_topics   |7     |" in out and "integer candle_volume" in out
    command(["export", root, "--out", f"{root}/export"])
    assert spark.read.text(f"{root}/export/dim_topics").count() == 3
    with pytest.raises(SystemExit):
        command(["export", root])


def test_second_day_adds_to_the_first(spark, tmp_path, rows):
    paths = daily.Paths(str(tmp_path))
    land(tmp_path)
    daily.run_all(spark, RUN, paths, "2025-09-16 01:00:00")
    first = snapshot(spark, paths, rows)
    tomorrow = RUN + datetime.timedelta(days=1)
    later = [
        article("one", time_published="20250916T080000", url="https://x/other"),
        article("one"),
        article("new", time_published="20250916T090000", topics=[{"topic": "A", "relevance_score": "1"}]),
    ]
    land(tmp_path, news=later, day=RUN)
    daily.run_all(spark, tomorrow, paths, "2025-09-17 01:00:00")
    second = snapshot(spark, paths, rows)
    for name, old in first.items():
        assert set(map(repr, old)) <= set(map(repr, second[name])), name
    tables = daily.warehouse_tables(spark, paths)
    # A second snapshot of three companies, later keys winning from now on.
    assert rows(tables["dim_companies"], "company_key") == [(i,) for i in range(1, 7)]
    assert rows(tables["dim_time"], "time_key", "time_day_of_week") == [
        (1, "Monday"), (2, "Tuesday"),
    ]
    assert rows(tables["dim_topics"])[-1] == (4, "A")
    # The article seen before keeps its key; two others are new.
    assert rows(tables["dim_news"], "news_key") == [(i,) for i in range(1, 7)]
    today = tables["fact_news_companies"].where(F.col("dt") == F.lit(RUN))
    assert rows(today, "news_company_company_key", "news_company_news_key") == [(5, 3), (5, 5), (5, 6)]
    for fact, key in (
        ("fact_candles", "candle_key"),
        ("fact_news_topics", "news_topic_key"),
        ("fact_news_companies", "news_company_key"),
    ):
        counts = tables[fact].agg(F.count("*"), F.countDistinct(key)).first()
        assert counts[0] == counts[1] == len(second[fact])


def test_unmatched_candles_are_counted(spark, run):
    tables = daily.warehouse_tables(spark, run[1])
    candles = read_partition(spark, run[1].silver("ohlcs"), DAY, schemas.SILVER_CANDLES)
    seen = Observation()
    latest = gold.latest_companies(tables["dim_companies"])
    facts = gold.build_fact_candles(candles.drop("dt"), latest, 1, seen)
    assert facts.count() == 2
    assert seen.get == {"n_read": 3, "n_unmatched": 1}


def test_link_topics_either(spark, run, rows):
    tables = daily.warehouse_tables(spark, run[1])
    news = read_partition(spark, run[1].silver("news"), DAY, schemas.SILVER_NEWS)
    links = gold.link_topics_either(
        news,
        tables["dim_news"].where("news_title = 'two'"),
        tables["dim_topics"].where("topic_name = 'IPO'"),
    )
    assert rows(links) == [(4, 2, 1.0), (4, None, 0.0), (None, 2, 0.5), (None, 2, 0.5), (None, 2, 1.0)]


def test_title_join_counts(spark, run, rows):
    news = read_partition(spark, run[1].silver("news"), DAY, schemas.SILVER_NEWS)
    counts = gold.title_join_counts(news, news, ["topic_name"])
    joined = news.alias("f").join(news.alias("d"), "news_title")
    assert rows(counts) == rows(joined.groupBy("news_title", "f.topic_name").count())


def test_serving(spark, run):
    tables = daily.warehouse_tables(spark, run[1])
    assert serving.serve(tables, "dim_news").columns == serving.VIEWS["dim_news"]
    assert serving.serve(tables, "fact_candles", candle_time_key="1").count() == 2
    assert serving.serve(tables, "fact_candles", candle_time_key=2).count() == 0
    for bad in ({}, {"candle_time_key": ""}, {"candle_time_key": "x"}):
        with pytest.raises(ValueError):
            serving.serve(tables, "fact_candles", **bad)
    counts = {r.table_name: r.n_rows for r in serving.profile(tables).collect()}
    assert counts["dim_time"] == 1 and counts["fact_news_topics"] == 7
    assert serving.preview(tables["fact_news_topics"], 3).count() == 3


def test_sql_over_the_views(spark, run):
    serving.register_views(daily.warehouse_tables(spark, run[1]))
    joined = spark.sql(
        """select company_ticker, count(*) n from fact_candles
        join dim_companies on candle_company_key = company_key group by 1 order by 1"""
    )
    assert [tuple(r) for r in joined.collect()] == [("AAA", 1), ("BBB", 1)]


def test_constraints(spark, run, rows):
    tables = daily.source_tables(spark, run[1]) | daily.warehouse_tables(spark, run[1])
    # One volume is beyond INT, and two SIC ids have the same texts; both are kept.
    assert rows(checks.constraint_report(tables)) == [
        ("fact_candles", "integer candle_volume", 1),
        ("sic_industries", "unique sic_industry, sic_sector", 1),
    ]
    broken = {
        "regions": tables["regions"].unionAll(tables["regions"].where("region_id = 1")),
        "exchanges": tables["exchanges"].withColumn("exchange_region_id", F.col("exchange_id")),
        "dim_topics": tables["dim_topics"].withColumn("topic_key", F.lit(None).cast("long")),
        "industries": tables["industries"].withColumn("industry_name", F.repeat(F.lit("x"), 201)),
    }
    assert rows(checks.constraint_report(broken)) == [
        ("dim_topics", "not null topic_key", 3),
        ("exchanges", "exchange_region_id in regions", 8),
        ("industries", "length of industry_name", 2),
        ("regions", "unique region_id", 1),
        ("regions", "unique region_name", 1),
    ]


def test_a_key_is_read_from_its_range_alone(spark, tmp_path, monkeypatch):
    """Dimensions in ranges of two keys: one folder is opened, whatever it holds."""
    path = str(tmp_path / "dim")
    monkeypatch.setitem(schemas.KEY_RANGES, "dim_news", ("news_key", 2))
    for keys in ((1, 4), (4, 8)):
        rows = spark.range(*keys).select(
            *[
                (F.col("id") if f.name == "news_key" else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schemas.DIM_NEWS.fields
            ]
        )
        append_key_ranges(rows, path, *schemas.KEY_RANGES["dim_news"])
    served = serving.serve_key(spark, path, "dim_news", "5")
    assert [r.news_key for r in served.collect()] == [5] and served.columns == serving.VIEWS["dim_news"]
    assert {file.split("/")[-2] for file in served.inputFiles()} == {"news_key_range=2"}
    assert serving.serve_key(spark, path, "dim_news", 99).count() == 0
    with pytest.raises(ValueError, match="must be an integer"):
        serving.serve_key(spark, path, "dim_news", "x")


def test_runs_write_ranges_of_keys(spark, run):
    served = serving.serve_key(spark, run[1].gold("dim_news"), "dim_news", 1)
    want = serving.serve(daily.warehouse_tables(spark, run[1]), "dim_news", news_key=1)
    assert served.collect() == want.collect() != []


def test_served_candles_are_pruned_to_their_day(spark, run):
    tables = daily.warehouse_tables(spark, run[1])
    plan = serving.serve(tables, "fact_candles", candle_time_key=1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(candle_time_key" in plan


def test_export(spark, run, tmp_path):
    tables = daily.warehouse_tables(spark, run[1])
    serving.export_warehouse(tables, str(tmp_path))
    exported = spark.read.text(f"{tmp_path}/dim_time").collect()
    assert [json.loads(r.value) for r in exported] == [
        {"time_date": "Mon, 15 Sep 2025 00:00:00 GMT", "time_day_of_week": "Monday",
         "time_key": 1, "time_month": "September", "time_quarter": "3", "time_year": 2025}
    ]
    assert spark.read.text(f"{tmp_path}/fact_candles").count() == 2


def test_missing_day_is_an_error_unless_allowed(spark, run, rows):
    before = snapshot(spark, run[1], rows)
    weekend = datetime.date(2025, 9, 22)
    with pytest.raises(AnalysisException):
        daily.land_bronze(spark, weekend, run[1])
    daily.land_bronze(spark, weekend, run[1], missing_ok=True)
    with pytest.raises(AnalysisException):
        daily.refine_silver(spark, weekend + datetime.timedelta(days=7), run[1])
    daily.refine_silver(spark, weekend, run[1], missing_ok=True)
    sunday = weekend - datetime.timedelta(days=1)
    for name, schema in (("articles", schemas.SILVER_ARTICLES), ("news", schemas.SILVER_NEWS)):
        if name == "news":
            daily.write_news_product(spark, weekend, run[1])
        assert read_partition(spark, run[1].silver(name), sunday, schema).count() == 0
    assert snapshot(spark, run[1], rows) == before


def test_init_warehouse(spark, tmp_path):
    paths = daily.Paths(str(tmp_path))
    daily.init_warehouse(spark, paths)
    tables = daily.warehouse_tables(spark, paths)
    for name, schema in schemas.WAREHOUSE_TABLES.items():
        assert tables[name].count() == 0
        assert set(schema.names) <= set(tables[name].columns)
    with pytest.raises(AnalysisException):
        daily.init_warehouse(spark, paths)
    daily.init_warehouse(spark, paths, replace=True)


def test_latest_company_is_the_last_load_then_the_highest_key(spark, rows):
    dim = spark.createDataFrame(
        [(1, "A", "2024-01-02"), (2, "A", "2024-01-02"), (9, "A", "2024-01-01")],
        "company_key BIGINT, company_ticker STRING, at STRING",
    ).withColumn("company_update_time_stamp", F.col("at").cast("timestamp"))
    assert rows(gold.latest_companies(dim), "company_key") == [(2,)]
    assert latest_by(dim, ["company_ticker"], ["company_update_time_stamp", "company_key"]).count() == 1


def test_sic_ids_must_be_numbers(spark, rows):
    given = spark.createDataFrame(
        [("3674", "Semis", "Tech"), ("x", "Bad", "Tech"), ("3674", "Semis", " ")],
        "sic STRING, sicIndustry STRING, sicSector STRING",
    )
    assert rows(source_db.normalise_sic(given)) == [(3674, "Semis", "Tech")]


def test_clean_articles_keep_distinct_items(spark):
    bronze = spark.createDataFrame(
        [([("a ", "1"), ("a", "1.0"), (None, "x")],)],
        "topics ARRAY<STRUCT<topic: STRING, relevance_score: STRING>>",
    )
    missing = [f for f in schemas.NEWS.fields if f.name != "topics"]
    full = bronze.select(
        "topics", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]
    )
    row = silver.clean_articles(full).first()
    assert [tuple(t) for t in row.topics] == [("a", 1.0), ("n/a", 0.0)]
    assert [tuple(t) for t in row.ticker_sentiment] == [("n/a", 0.0, 0.0, "n/a")]


def test_landed_texts_are_packed_and_in_files_of_so_many_rows(spark, tmp_path, monkeypatch):
    """Neither the size of a landed file nor the plain text on disk grows with the input."""
    from stocklake.plans import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 1000)
    sf, paths = "/root/testdata/sf0.001", daily.Paths(str(tmp_path))
    queries.land_payloads(spark, sf, paths, datetime.date(2024, 3, 1))
    for name, made in (("news", queries.given.news), ("ohlcs", queries.given.candle_payloads)):
        landed = spark.read.text(paths.landing(name))
        assert landed.count() == made(spark, sf).count()
        files = landed.inputFiles()
        assert all(f.endswith(".gz") for f in files) and len(files) >= landed.count() / 1000
    bronze = spark.read.parquet(queries.land_news(spark, sf))
    assert len(bronze.inputFiles()) >= bronze.count() / 1000


def articles_of(spark, rows):
    """Silver articles of (title, summary, topics)."""
    made = spark.createDataFrame(rows, "title STRING, summary STRING, topics ARRAY<STRUCT<topic: STRING, relevance_score: DOUBLE>>")
    given = {
        "news_title": F.col("title"),
        "news_url": F.lit("u"),
        "news_time_published": F.lit("2024-01-01 00:00:00"),
        "news_summary": F.col("summary"),
        "topics": F.col("topics"),
    }
    return made.select(
        *[given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.SILVER_ARTICLES.fields]
    )


def test_a_batch_gets_its_keys_from_the_sort_that_finds_new_articles(spark, rows):
    """As the dimension's rows and a join with them give; new articles are not joined with it."""
    batch = articles_of(
        spark,
        [
            ("c", "1", [("x", 1.0), ("y", -0.0)]),
            ("b", "2", [("x", 1.0), ("z", 2.0)]),
            ("b", "1", [("x", 1.0)]),
            ("b", "1", [("x", 3.0)]),
            ("a", "1", [("x", 1.0)]),
            ("k", "9", [("x", 1.0)]),
            (None, "1", [("x", 1.0)]),
            (None, "2", [("x", 1.0)]),
        ],
    )
    known = articles_of(spark, [("k", "0", [])]).drop("topics", "ticker_sentiment")
    dim = known.select(F.lit(5).cast("long").alias("news_key"), "*", F.lit(1).cast("long").alias("news_time_key"))
    for before in (dim, dim.where(F.lit(False))):
        new, single, rest = gold.key_batch(batch, before, 7)
        want = gold.build_dim_news(batch, before, 7)
        columns = [c for c in want.columns if c != "news_authors"]
        null_title = F.col("news_title").isNull()
        assert rows(new.where(~null_title), *columns) == rows(want.where(~null_title), *columns)
        assert new.where(null_title).count() == want.where(null_title).count() == 2
        whole = gold.key_articles(batch, before.unionByName(want))
        keyed = ["news_key", "topics"]
        assert rows(single.unionByName(rest), *keyed) == rows(whole, *keyed)
        keys = {r.news_key for r in single.collect()}
        assert keys.isdisjoint({r.news_key for r in rest.collect()}) and len(keys) >= 2
        plan = single._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") == 1 and "_offset" in plan, "only with the sizes of the files"
        topics = gold.build_dim_topics(silver.news_topics(batch), spark.createDataFrame([], schemas.DIM_TOPICS))
        by = ["news_key"]
        facts = gold.build_fact_news_topics(
            silver.news_topics(rest, by), topics, 3, silver.news_topics(single, by)
        )
        # The keys too are those of one table, and -0.0 is 0.0.
        assert rows(facts) == rows(gold.build_fact_news_topics(silver.news_topics(whole, by), topics, 3))


def test_a_batch_without_new_articles_gets_the_known_keys(spark, rows):
    batch = articles_of(spark, [("a", "1", [("x", 1.0)])])
    dim = gold.build_dim_news(batch, spark.createDataFrame([], schemas.DIM_NEWS), 7)
    new, single, rest = gold.key_batch(batch, dim, 8)
    assert new.count() == single.count() == 0
    assert rows(rest, "news_key") == [(1,)]


def test_unknown_tickers_are_left_out_before_the_lookup(spark, rows):
    known = spark.range(0, 3000, 3).select(F.concat(F.lit("C"), "id").alias("t"))
    found = may_match(spark.range(3000).select(F.concat(F.lit("C"), "id").alias("ticker"), "id"), "ticker", known)
    assert found.where("id % 3 = 0").count() == 1000 and found.count() < 1100
    assert found.columns == ["ticker", "id"]


def test_exported_records_are_parsed_once(spark, tmp_path, rows):
    from stocklake.plans import queries

    facts = [(1, 2, 3, 0.25, 1e-7, "Bullish"), (2, 3, 4, 0.0, float("nan"), None)]
    table = spark.createDataFrame(facts, schemas.FACT_NEWS_COMPANIES)
    export_all({"fact_news_companies": table}, str(tmp_path))
    exported = queries.read_exported(spark, str(tmp_path), "fact_news_companies")
    plan = exported._jdf.queryExecution().toString()
    assert "get_json_object" not in plan and "from_json" not in plan
    assert [str(r) for r in rows(exported)] == [
        "('fact_news_companies', 2, 3, 'Bullish', None, 0.25, 1e-07)",
        "('fact_news_companies', 3, 4, None, None, 0.0, nan)",
    ]


def test_a_missing_table_is_planned_as_empty(spark, tmp_path):
    none = read_table(spark, str(tmp_path / "none"), schemas.DIM_TOPICS, missing_ok=True)
    joined = spark.range(5).join(none, F.col("id") == F.col("topic_key"), "left_anti")
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 5 and none.columns == schemas.DIM_TOPICS.names
