"""Bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklake import schemas
from stocklake.functions.dates import millis_to_ts, parse_compact_ts
from stocklake.functions.text import (
    clamp_score,
    clamp_scores,
    default_text,
    null_defaults,
    rename,
    replace_text,
    text_or_default,
    trim_columns,
)
from stocklake.operators.clean import dedup_rows
from stocklake.operators.explode import (
    by_suspicion,
    distinct_items,
    explode_distinct,
    explode_structs_outer,
    exploded_counts,
    stage_marked,
)

# Silver names of the landed fields.
NEWS_NAMES = {
    "title": "news_title",
    "url": "news_url",
    "time_published": "news_time_published",
    "authors": "news_authors",
    "summary": "news_summary",
    "source": "news_source",
    "overall_sentiment_score": "news_overall_sentiment_score",
    "overall_sentiment_label": "news_overall_sentiment_label",
}
CANDLE_NAMES = {
    "ticker": "company_ticker",
    "v": "candle_volume",
    "vw": "candle_volume_weighted",
    "o": "candle_open",
    "c": "candle_close",
    "h": "candle_high",
    "l": "candle_low",
    "t": "candle_time_stamp",
    "n": "candle_num_of_trades",
    "otc": "candle_is_otc",
}
MENTION_FIELDS = {
    "ticker": "news_ticker",
    "relevance_score": "news_company_relevance_score",
    "ticker_sentiment_score": "news_company_ticker_sentiment_score",
    "ticker_sentiment_label": "news_company_ticker_sentiment_label",
}
TOPIC_FIELDS = {"topic": "topic_name", "relevance_score": "news_topic_relevance_score"}
COMPANY_TEXT = [
    "company_name",
    "company_ticker",
    "company_category",
    "company_exchange_name",
    "company_industry_name",
    "company_industry_sector",
    "company_sic_industry",
    "company_sic_sector",
]
ARTICLE_KEY = ["news_title", "news_url", "news_time_published"]


def clean_articles(bronze: DataFrame) -> DataFrame:
    """One row per landed article: text and scores cleaned, both arrays kept.

    The arrays are cleaned in place and hold distinct items; an article without any
    gets one item of defaults.
    """
    articles = rename(
        bronze.drop("banner_image", "source_domain", "category_within_source", "dt"),
        NEWS_NAMES,
    )
    articles = articles.withColumn(
        "news_time_published", parse_compact_ts(F.col("news_time_published"))
    )
    articles = default_text(
        articles,
        ARTICLE_KEY + ["news_summary", "news_source", "news_overall_sentiment_label"],
    )
    articles = clamp_scores(articles, ["news_overall_sentiment_score"])
    mentions = distinct_items(
        F.col("ticker_sentiment"),
        lambda m: F.struct(
            text_or_default(m["ticker"]).alias("ticker"),
            clamp_score(m["relevance_score"]).alias("relevance_score"),
            clamp_score(m["ticker_sentiment_score"]).alias("ticker_sentiment_score"),
            text_or_default(m["ticker_sentiment_label"]).alias("ticker_sentiment_label"),
        ),
        F.struct(
            F.lit("n/a").alias("ticker"),
            F.lit(0.0).alias("relevance_score"),
            F.lit(0.0).alias("ticker_sentiment_score"),
            F.lit("n/a").alias("ticker_sentiment_label"),
        ),
    )
    topics = distinct_items(
        F.col("topics"),
        lambda t: F.struct(
            text_or_default(t["topic"]).alias("topic"),
            clamp_score(t["relevance_score"]).alias("relevance_score"),
        ),
        F.struct(F.lit("n/a").alias("topic"), F.lit(0.0).alias("relevance_score")),
    )
    return articles.withColumns({"ticker_sentiment": mentions, "topics": topics}).select(
        *NEWS_NAMES.values(), "ticker_sentiment", "topics"
    )


ARRAYS = {"ticker_sentiment": MENTION_FIELDS, "topics": TOPIC_FIELDS}


def silver_articles(bronze: DataFrame) -> DataFrame:
    """The distinct cleaned articles with their arrays: what the warehouse is loaded from.

    Equal articles are equal in their texts, so only rows that may share all of these with
    another one are shuffled.
    """
    texts = ("title", "url", "summary", "source", "overall_sentiment_label")
    mark = F.xxhash64(*[text_or_default(F.col(c)) for c in texts], "authors")
    sure, suspects = by_suspicion(bronze.withColumn("_mark", mark))
    return clean_articles(sure).unionByName(dedup_rows(clean_articles(suspects)))


def silver_news(bronze: DataFrame) -> DataFrame:
    """Distinct rows of article x ticker x topic, from one scan of bronze."""
    return explode_distinct(stage_marked(clean_articles(bronze), ARRAYS, "articles"), ARRAYS)


def news_copies(bronze: DataFrame, *keeps: str | None) -> list[DataFrame]:
    """Titles, with the items of one array if asked for, and how many rows of
    ``silver_news`` each stands for (``copies``): a frame per entry of ``keeps``, all from
    one scan of bronze."""
    marked = stage_marked(clean_articles(bronze), ARRAYS, "titles", keep=["news_title"])
    return exploded_counts(marked, ARRAYS, ["news_title"], list(keeps))


def news_mentions(articles: DataFrame, by=tuple(ARTICLE_KEY)) -> DataFrame:
    """The ticker columns of cleaned articles and what they are told apart by."""
    narrow = articles.select(*by, "ticker_sentiment")
    return explode_structs_outer(narrow, "ticker_sentiment", MENTION_FIELDS)


def news_topics(articles: DataFrame, by=tuple(ARTICLE_KEY)) -> DataFrame:
    """The topic columns of cleaned articles and what they are told apart by."""
    return explode_structs_outer(articles.select(*by, "topics"), "topics", TOPIC_FIELDS)


def silver_candles(bronze: DataFrame) -> DataFrame:
    """Distinct candles with defaults for what the payload leaves out."""
    counts = {c: F.col(c).try_cast("bigint") for c in ("v", "n")}
    typed = bronze.select(*CANDLE_NAMES).withColumns(
        {**counts, "t": millis_to_ts(F.col("t")), "ticker": F.trim("ticker")}
    )
    filled = null_defaults(typed, {"otc": False, "n": 0, "v": 0, "vw": 0.0})
    return dedup_rows(rename(filled, CANDLE_NAMES)).select(*schemas.SILVER_CANDLES.names)


def silver_companies(bronze: DataFrame) -> DataFrame:
    """Distinct companies, trimmed, with the country spelled out."""
    trimmed = trim_columns(bronze.drop("dt"), COMPANY_TEXT)
    return dedup_rows(
        replace_text(trimmed, "company_location", r"U\.S\.A", "United States")
    )
