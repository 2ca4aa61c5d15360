"""Silver to the star schema. Each function returns rows; the daily run writes them.

Dimensions are append-only and only get what they lack, so their keys never change.
Facts carry keys that repeat when a day is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stocklake import schemas
from stocklake.functions.dates import as_date, calendar_columns
from stocklake.operators.clean import dedup_rows
from stocklake.operators.incremental import CurrentVersions
from stocklake.operators.joins import (
    absent_from,
    fanout_counts,
    lookup,
    may_match,
    not_in,
    within_bounds,
)
from stocklake.operators.keys import bucketed_keys
from stocklake.operators.latest import latest_by
from stocklake.operators.upsert import append_new, append_snapshot, insert_ignore, key_new
from stocklake.plans.silver import ARTICLE_KEY
from stocklake.session import stage

#: Stands for a time that could not be read.
MISSING = "n/a"
ARTICLE_COLUMNS = schemas.DIM_NEWS.names[1:-1]


def build_dim_companies(silver: DataFrame, dim: DataFrame, load_ts: Column) -> DataFrame:
    """A snapshot of the companies to append, stamped with ``load_ts``.

    A load is known by the day of its stamp: companies already loaded on that day are
    left out, so a day's load can be repeated at any hour. Ticker and delisting must be
    set.
    """
    identity = ["company_ticker", "company_is_delisted"]
    rows = silver.na.drop("any", subset=identity).select(*schemas.SILVER_COMPANIES.names)
    order = [c for c in rows.columns if c not in identity]
    same_load = dim.where(F.to_date("company_update_time_stamp") == F.to_date(load_ts))
    new = insert_ignore(rows, same_load, identity, order)
    stamped = new.withColumn("company_update_time_stamp", load_ts)
    return append_snapshot(stamped, dim, "company_key", identity + order)


def latest_companies(dim: DataFrame) -> DataFrame:
    """Ticker and key of the version loaded last; within a load the highest key.

    Staged, as it is far smaller than the history of snapshots it is taken from and
    every fact is joined to it.
    """
    versions = dim.select("company_ticker", "company_update_time_stamp", "company_key")
    latest = latest_by(
        versions, ["company_ticker"], ["company_update_time_stamp", "company_key"]
    )
    return stage(latest.select("company_ticker", "company_key"), "companies")


def current_companies(
    spark: SparkSession, path: str, dim: DataFrame, load_ts: Column
) -> DataFrame:
    """Ticker and key of the newest version, from a table that is kept up with each load.

    Only the snapshot of this load is merged into it; the first time, all of them are. The
    same rows as ``latest_companies`` gives of the whole history.
    """
    identity, order = ["company_ticker"], ["company_update_time_stamp", "company_key"]
    schema = dim.select(*identity, *order).schema
    current = CurrentVersions(spark, path, schema, identity, order)
    loaded = dim.where(F.to_date("company_update_time_stamp") == F.to_date(load_ts))
    newest = current.merge(dim if current.ledger.read() is None else loaded)
    return newest.select("company_ticker", "company_key")


def dates_frame(spark: SparkSession, run_date) -> DataFrame:
    return spark.range(1).select(F.lit(as_date(run_date)).alias("time_date"))


def build_dim_time(dates: DataFrame, dim: DataFrame) -> DataFrame:
    """Calendar rows to append for the dates (``time_date``) the dimension lacks."""
    days = dates.select("time_date").where(F.col("time_date").isNotNull())
    missing = absent_from(dedup_rows(days), dim, "time_date")
    return append_snapshot(
        calendar_columns(missing, "time_date"), dim, "time_key", ["time_date"]
    )


def time_key(dim_time: DataFrame, run_date) -> int:
    """The key of one loaded date."""
    day = dim_time.where(F.col("time_date") == F.lit(as_date(run_date)))
    return day.agg(F.max("time_key")).first()[0]


def build_dim_topics(news: DataFrame, dim: DataFrame) -> DataFrame:
    """Topics to append: the distinct ones that are not in the dimension."""
    topics = dedup_rows(news.select("topic_name"))
    return append_snapshot(not_in(topics, dim, "topic_name"), dim, "topic_key", ["topic_name"])


def known_news(dim: DataFrame, articles: DataFrame) -> DataFrame:
    """The part of the article dimension that a batch of articles can refer to.

    The time of publication is part of the article key, so a day's load leaves all
    years outside its own times unread and unshuffled. Articles without a time are
    looked up among those without.
    """
    return within_bounds(dim, articles, "news_time_published", stand_in=MISSING)


def build_dim_news(articles: DataFrame, dim: DataFrame, news_time_key: int) -> DataFrame:
    """Articles to append, one row each: title, url and time tell them apart."""
    rows = articles.select(*ARTICLE_COLUMNS)
    order = [c for c in ARTICLE_COLUMNS if c not in ARTICLE_KEY]
    known = known_news(dim, articles)
    time_key = {"news_time_key": F.lit(news_time_key).cast("long")}
    return append_new(rows, known, dim, "news_key", ARTICLE_KEY, order, time_key)


def key_batch(
    articles: DataFrame, dim: DataFrame, news_time_key: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A batch of articles with their arrays: the rows of ``build_dim_news``, and all
    articles by their key in two parts.

    The first part has those that are the only one of a new key, the other the rest:
    several versions of one article, and articles ``dim`` has. The keys come with the
    sort that finds the new rows, so new articles are not joined with the dimension.
    """
    order = [c for c in ARTICLE_COLUMNS if c not in ARTICLE_KEY]
    known = known_news(dim, articles)
    first, further = key_new(articles, known, dim, "news_key", ARTICLE_KEY, order)
    rows = first.withColumn("news_time_key", F.lit(news_time_key).cast("long")).select(*dim.columns)
    keyed = ["news_key", "ticker_sentiment", "topics"]
    versions = first.where("_more").select(*keyed).unionByName(further.select(*keyed))
    found = key_articles(articles, known).select(*keyed)
    return rows, first.where("not _more").select(*keyed), versions.unionByName(found)


def build_fact_candles(
    candles: DataFrame,
    companies: DataFrame,
    candle_time_key: int,
    unmatched: Observation | None = None,
) -> DataFrame:
    """Candles of known ``companies`` (see ``latest_companies``).

    With an observation, the numbers of candles read and of those without a company
    (``n_read``, ``n_unmatched``) are counted by the same job that writes the rest.
    """
    how = "inner" if unmatched is None else "left"
    joined = lookup(
        candles,
        companies,
        {"company_ticker": "company_ticker"},
        ["company_key"],
        how=how,
    )
    if unmatched is not None:
        missing = F.count_if(F.col("company_key").isNull())
        joined = joined.observe(
            unmatched, F.count("*").alias("n_read"), missing.alias("n_unmatched")
        ).where(F.col("company_key").isNotNull())
    rows = joined.withColumnRenamed("company_key", "candle_company_key").withColumn(
        "candle_time_key", F.lit(candle_time_key).cast("long")
    )
    # Numbered by ticker, which does not change with the load of companies.
    natural = schemas.SILVER_CANDLES.names
    return bucketed_keys(rows, natural, "candle_key", candle_time_key).select(
        *schemas.FACT_CANDLES.names
    )


def key_articles(rows: DataFrame, dim_news: DataFrame) -> DataFrame:
    """Add ``news_key`` to known articles; the others are dropped.

    Best done before the arrays are exploded: then one row per article is shuffled,
    and everything after it moves a number instead of title, url and time.
    """
    return lookup(rows, dim_news, {c: c for c in ARTICLE_KEY}, ["news_key"], "inner")


def _distinct_links(links: DataFrame, single: DataFrame | None) -> DataFrame:
    """The distinct rows of both; those of ``single`` are distinct as they are.

    Making rows distinct turns a score of -0.0 into 0.0; so does adding 0.0.
    """
    rows = dedup_rows(links)
    if single is None:
        return rows
    scores = {f.name: F.col(f.name) + F.lit(0.0) for f in single.schema.fields if f.dataType.typeName() == "double"}
    return rows.unionByName(single.withColumns(scores))


def link_topics(
    keyed: DataFrame, dim_topics: DataFrame, single: DataFrame | None = None
) -> DataFrame:
    """Distinct article and topic keys with their score.

    ``single`` has further rows, of articles that are the only one of their key; with their
    arrays distinct, these rows are not shuffled to be made so.
    """
    columns = ["news_key", "topic_name", "news_topic_relevance_score"]
    rows = _distinct_links(keyed.select(*columns), None if single is None else single.select(*columns))
    linked = lookup(rows, dim_topics, {"topic_name": "topic_name"}, ["topic_key"], "inner")
    return _topic_links(linked)


def link_topics_either(
    topics: DataFrame, dim_news: DataFrame, dim_topics: DataFrame
) -> DataFrame:
    """Distinct topic rows with both keys, also those that lack one of the two."""
    rows = dedup_rows(topics.select(*ARTICLE_KEY, "topic_name", "news_topic_relevance_score"))
    with_topic = lookup(rows, dim_topics, {"topic_name": "topic_name"}, ["topic_key"])
    linked = lookup(with_topic, dim_news, {c: c for c in ARTICLE_KEY}, ["news_key"])
    return _topic_links(
        linked.where(F.col("news_key").isNotNull() | F.col("topic_key").isNotNull())
    )


def _topic_links(linked: DataFrame) -> DataFrame:
    return linked.select(
        F.col("news_key").alias("news_topic_news_key"),
        F.col("topic_key").alias("news_topic_topic_key"),
        "news_topic_relevance_score",
    )


def link_companies(
    keyed: DataFrame, companies: DataFrame, single: DataFrame | None = None
) -> DataFrame:
    """Distinct article and company keys with their scores; the company must be known.

    ``single`` is that of ``link_topics``. Most tickers of a feed may be unknown, and those
    are left out before the lookup.
    """
    tickers = companies.select("company_ticker")

    def linked(rows: DataFrame) -> DataFrame:
        known = may_match(rows, "news_ticker", tickers)
        on = {"news_ticker": "company_ticker"}
        return lookup(known, companies, on, ["company_key"], how="inner").select(
            F.col("company_key").alias("news_company_company_key"),
            F.col("news_key").alias("news_company_news_key"),
            *schemas.FACT_NEWS_COMPANIES.names[3:],
        )

    return _distinct_links(linked(keyed), None if single is None else linked(single))


def build_fact_news_topics(
    keyed: DataFrame, dim_topics: DataFrame, run_time_key: int, single: DataFrame | None = None
) -> DataFrame:
    links = link_topics(keyed, dim_topics, single)
    return bucketed_keys(links, links.columns, "news_topic_key", run_time_key)


def build_fact_news_companies(
    keyed: DataFrame, companies: DataFrame, run_time_key: int, single: DataFrame | None = None
) -> DataFrame:
    links = link_companies(keyed, companies, single)
    return bucketed_keys(links, links.columns, "news_company_key", run_time_key)


def title_join_counts(
    facts: DataFrame, news: DataFrame, value_cols: list[str], copies: str | None = None
) -> DataFrame:
    """How often a load that joins facts to articles by title alone repeats each fact.

    Such a load has one article row per silver row and matches every one of the same
    title, so k silver rows of a title become k x k facts. The rows are counted
    (``n_rows``), not built. ``facts`` are the silver rows a load would keep,
    ``news`` all of them; with ``copies`` both may be counts of them.
    """
    count = [copies] if copies else []
    facts = facts.select("news_title", *value_cols, *count)
    news = news.select("news_title", *count)
    return fanout_counts(facts, news, ["news_title"], "n_rows", copies)
