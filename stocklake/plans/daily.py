"""The daily runs, from landed payloads to the star schema."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklake import schemas
from stocklake.functions.dates import as_date
from stocklake.plans import gold, silver, source_db
from stocklake.sources.files import (
    if_found,
    read_json_array,
    read_json_lines,
    read_latest_json_array,
    read_partition,
    read_table,
    read_texts,
)
from stocklake.sources.payloads import candles_from_text, unnest_envelope
from stocklake.sources.writers import (
    append_key_ranges,
    append_table,
    write_json_lines,
    write_partition,
)


@dataclass(frozen=True)
class Paths:
    """Folder layout below one root on the shared file system.

    ``landing/<name>/dt=...`` holds the day's payloads, one per line: envelopes for
    news and ohlcs, JSON arrays for companies and markets. The latter two may also
    be whole documents in ``landing/<name>``, of which the newest counts.
    """

    root: str

    def landing(self, name: str) -> str:
        return f"{self.root}/landing/{name}"

    def processed(self, name: str, day) -> str:
        return f"{self.root}/processed/{name}/dt={as_date(day).isoformat()}"

    def source(self, table: str) -> str:
        return f"{self.root}/source/{table}"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"


def landed_records(
    spark: SparkSession, folder: str, run_date, schema, missing_ok=False
) -> DataFrame:
    """The day's array payloads, or the folder's newest document if there is no such day.

    Neither of them is an error unless ``missing_ok``.
    """
    day = f"{folder}/dt={as_date(run_date).isoformat()}"
    rows = if_found(lambda: read_json_array(spark, day, schema, one_document_per_line=True))
    if rows is not None:
        return rows
    newest = if_found(lambda: read_latest_json_array(spark, folder, schema, missing_ok))
    if newest is None and not missing_ok:
        raise FileNotFoundError(f"no landed payloads in {folder}")
    return spark.createDataFrame([], schema) if newest is None else newest


def run_source_db(
    spark: SparkSession, run_date, paths: Paths, load_ts, missing_ok=False
) -> None:
    """Newest markets and companies payloads into the five source tables."""
    stamp = F.lit(load_ts).cast("timestamp")

    def landed(name: str, schema) -> DataFrame:
        return landed_records(spark, paths.landing(name), run_date, schema, missing_ok)

    markets = landed("markets", schemas.MARKETS)
    companies = landed("companies", schemas.COMPANIES)

    def land(name: str, rows: DataFrame) -> DataFrame:
        path = paths.processed(name, run_date)
        write_json_lines(rows, path)
        return read_json_lines(spark, path, rows.schema)

    def load(name: str, rows: DataFrame, conflict: list[str], key: str | None) -> DataFrame:
        rows = land(name, rows)
        return source_db.load_table(spark, rows, paths.source(name), name, conflict, stamp, key)

    regions = load(
        "regions", source_db.normalise_regions(markets), ["region_name"], "region_id"
    )
    industries = load(
        "industries",
        source_db.normalise_industries(companies),
        ["industry_name", "industry_sector"],
        "industry_id",
    )
    load("sic_industries", source_db.normalise_sic(companies), ["sic_id"], None)
    exchanges = load(
        "exchanges",
        source_db.normalise_exchanges(markets, regions),
        ["exchange_name"],
        "exchange_id",
    )
    load(
        "companies",
        source_db.normalise_companies(companies, exchanges, industries),
        ["company_ticker", "company_is_delisted"],
        "company_id",
    )


def land_bronze(spark: SparkSession, run_date, paths: Paths, missing_ok=False) -> None:
    """The day's news and candle payloads, and today's companies, to bronze.

    A missing day, a broken payload or one without its records is an error;
    ``missing_ok`` accepts the first only. A payload that is an error report has to be
    landed anew or taken out of the day's folder.
    """
    news_day, company_day = _days(run_date)

    def texts(name: str) -> DataFrame:
        return read_texts(spark, f"{paths.landing(name)}/dt={news_day}", missing_ok)

    write_partition(
        unnest_envelope(texts("news"), "feed", schemas.NEWS_ENVELOPE),
        paths.bronze("news"),
        news_day,
    )
    write_partition(candles_from_text(texts("ohlcs")), paths.bronze("ohlcs"), news_day)
    snapshot = source_db.company_snapshot(**source_tables(spark, paths))
    write_partition(snapshot, paths.bronze("companies"), company_day)


def refine_silver(spark: SparkSession, run_date, paths: Paths, missing_ok=False) -> None:
    """Bronze days to silver days.

    News are kept as distinct articles with their arrays, which is all gold reads; their
    product of tickers and topics is written by ``write_news_product``.
    """
    news_day, company_day = _days(run_date)
    for name, day, schema, clean in (
        ("articles", news_day, schemas.NEWS, silver.silver_articles),
        ("ohlcs", news_day, schemas.CANDLES, silver.silver_candles),
        ("companies", company_day, schemas.SILVER_COMPANIES, silver.silver_companies),
    ):
        landed = paths.bronze("news" if name == "articles" else name)
        bronze = read_partition(spark, landed, day, schema, missing_ok)
        write_partition(clean(bronze), paths.silver(name), day)


def write_news_product(spark: SparkSession, run_date, paths: Paths, missing_ok=False) -> None:
    """The day's news as rows of article x ticker x topic, for readers who need them."""
    news_day, _ = _days(run_date)
    bronze = read_partition(spark, paths.bronze("news"), news_day, schemas.NEWS, missing_ok)
    write_partition(silver.silver_news(bronze), paths.silver("news"), news_day)


def load_gold(spark: SparkSession, run_date, paths: Paths, load_ts, missing_ok=False) -> None:
    """Silver days to dimensions and facts; a repeated run changes nothing.

    The news facts come from the silver articles, each array exploded on its own: the
    same distinct rows as from their product of tickers and topics, without building it.
    """
    news_day, company_day = _days(run_date)
    stamp = F.lit(load_ts).cast("timestamp")

    def dim(name: str) -> DataFrame:
        return _warehouse_table(spark, paths, name, missing_ok=True)

    companies = read_partition(
        spark, paths.silver("companies"), company_day, schemas.SILVER_COMPANIES, missing_ok
    )
    append_key_ranges(
        gold.build_dim_companies(companies, dim("dim_companies"), stamp),
        paths.gold("dim_companies"),
        *schemas.KEY_RANGES["dim_companies"],
    )
    append_table(
        gold.build_dim_time(gold.dates_frame(spark, news_day), dim("dim_time")),
        paths.gold("dim_time"),
    )
    time_key = gold.time_key(dim("dim_time"), news_day)

    latest = gold.current_companies(
        spark, paths.gold("current_companies"), dim("dim_companies"), stamp
    )
    candles = read_partition(
        spark, paths.silver("ohlcs"), news_day, schemas.SILVER_CANDLES, missing_ok
    ).drop("dt")
    write_partition(
        gold.build_fact_candles(candles, latest, time_key),
        paths.gold("fact_candles"),
        time_key,
        schemas.PARTITIONS["fact_candles"],
    )

    articles = read_partition(
        spark, paths.silver("articles"), news_day, schemas.SILVER_ARTICLES, missing_ok
    ).drop("dt")
    topics = silver.news_topics(articles)
    append_table(
        gold.build_dim_topics(topics, dim("dim_topics")), paths.gold("dim_topics")
    )
    new, single, rest = gold.key_batch(articles, dim("dim_news"), time_key)
    append_key_ranges(new, paths.gold("dim_news"), *schemas.KEY_RANGES["dim_news"])
    by = ["news_key"]
    write_partition(
        gold.build_fact_news_topics(
            silver.news_topics(rest, by),
            dim("dim_topics"),
            time_key,
            silver.news_topics(single, by),
        ),
        paths.gold("fact_news_topics"),
        news_day,
    )
    write_partition(
        gold.build_fact_news_companies(
            silver.news_mentions(rest, by), latest, time_key, silver.news_mentions(single, by)
        ),
        paths.gold("fact_news_companies"),
        news_day,
    )


def run_warehouse(spark: SparkSession, run_date, paths: Paths, load_ts, missing_ok=False) -> None:
    """Bronze, silver and gold of one run date, in this order."""
    land_bronze(spark, run_date, paths, missing_ok)
    refine_silver(spark, run_date, paths, missing_ok)
    load_gold(spark, run_date, paths, load_ts, missing_ok)


def run_all(spark: SparkSession, run_date, paths: Paths, load_ts) -> None:
    """Source tables first, then the warehouse that reads them."""
    run_source_db(spark, run_date, paths, load_ts)
    run_warehouse(spark, run_date, paths, load_ts)


def init_warehouse(spark: SparkSession, paths: Paths, replace=False) -> None:
    """Write every warehouse table empty; existing ones are only replaced if asked."""
    mode = "overwrite" if replace else "errorifexists"
    for name, schema in schemas.WAREHOUSE_TABLES.items():
        empty = spark.createDataFrame([], schema)
        column = schemas.PARTITIONS.get(name)
        if column == "dt":
            empty = empty.withColumn("dt", F.lit(None).cast("date"))
        if name in schemas.KEY_RANGES:
            column = f"{schemas.KEY_RANGES[name][0]}_range"
            empty = empty.withColumn(column, F.lit(None).cast("long"))
        writer = empty.write.mode(mode)
        (writer.partitionBy(column) if column else writer).parquet(paths.gold(name))


def source_tables(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """All source tables; one that was never loaded is an error."""
    return {
        name: read_table(spark, paths.source(name), schema)
        for name, schema in schemas.SOURCE_TABLES.items()
    }


def warehouse_tables(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """All warehouse tables; one that was never written is an error."""
    return {name: _warehouse_table(spark, paths, name) for name in schemas.WAREHOUSE_TABLES}


def _warehouse_table(spark: SparkSession, paths: Paths, name: str, missing_ok=False) -> DataFrame:
    """One warehouse table; a range of keys is no column of its rows."""
    rows = read_table(spark, paths.gold(name), schemas.WAREHOUSE_TABLES[name], missing_ok)
    return rows.drop(f"{schemas.KEY_RANGES[name][0]}_range") if name in schemas.KEY_RANGES else rows


def _days(run_date) -> tuple[datetime.date, datetime.date]:
    """News and candles are those of the day before the run, companies of the day."""
    day = as_date(run_date)
    return day - datetime.timedelta(days=1), day
