"""Declared schemas of every layer. No job infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "STRINGS": T.ArrayType(T.StringType()),
}


def _struct(columns: str, **nested: T.DataType) -> T.StructType:
    """``name TYPE, ...``; a type that is no key of TYPES is taken from ``nested``."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(n, TYPES.get(t) or nested[t]) for n, t in pairs])


# Names and types of all columns, layer by layer.

# Landed payloads -----------------------------------------------------------

MARKETS = _struct(
    "market_type STRING, region STRING, primary_exchanges STRING, local_open STRING,"
    " local_close STRING, current_status STRING, notes STRING"
)
MARKETS_ENVELOPE = T.StructType([T.StructField("markets", T.ArrayType(MARKETS))])

COMPANIES = _struct(
    "name STRING, ticker STRING, exchange STRING, sector STRING, industry STRING,"
    " sic STRING, sicSector STRING, sicIndustry STRING, category STRING,"
    " currency STRING, location STRING, isDelisted BOOLEAN"
)

NEWS = _struct(
    "title STRING, url STRING, time_published STRING, authors STRINGS,"
    " summary STRING, source STRING, overall_sentiment_score DOUBLE,"
    " overall_sentiment_label STRING, banner_image STRING, source_domain STRING,"
    " category_within_source STRING, topics topics, ticker_sentiment mentions",
    topics=T.ArrayType(_struct("topic STRING, relevance_score STRING")),
    mentions=T.ArrayType(
        _struct(
            "ticker STRING, relevance_score STRING, ticker_sentiment_score STRING,"
            " ticker_sentiment_label STRING"
        )
    ),
)
NEWS_ENVELOPE = T.StructType([T.StructField("feed", T.ArrayType(NEWS))])

# The payload's field T (ticker) is named ``ticker`` from bronze on, so that it
# cannot clash with t (epoch milliseconds) in a case-insensitive session.
CANDLES = _struct(
    "ticker STRING, v DOUBLE, vw DOUBLE, o DOUBLE, c DOUBLE, h DOUBLE, l DOUBLE,"
    " t BIGINT, n BIGINT, otc BOOLEAN"
)
RAW_CANDLES = T.StructType([T.StructField("T", T.StringType())] + CANDLES.fields[1:])

# Source tables ---------------------------------------------------------------

REGIONS = _struct(
    "region_id BIGINT, region_name STRING, region_local_open STRING,"
    " region_local_close STRING, region_update_timestamp TIMESTAMP"
)
INDUSTRIES = _struct(
    "industry_id BIGINT, industry_name STRING, industry_sector STRING,"
    " database_update_timestamp TIMESTAMP"
)
SIC_INDUSTRIES = _struct(
    "sic_id BIGINT, sic_industry STRING, sic_sector STRING,"
    " database_update_timestamp TIMESTAMP"
)
EXCHANGES = _struct(
    "exchange_id BIGINT, exchange_region_id BIGINT, exchange_name STRING,"
    " database_update_timestamp TIMESTAMP"
)
SOURCE_COMPANIES = _struct(
    "company_id BIGINT, company_exchange_id BIGINT, company_industry_id BIGINT,"
    " company_sic_id BIGINT, company_name STRING, company_ticker STRING,"
    " company_is_delisted BOOLEAN, company_category STRING, company_currency STRING,"
    " company_location STRING, database_update_timestamp TIMESTAMP"
)

# Bronze and silver company snapshots share one layout; so do their days.

SILVER_COMPANIES = _struct(
    "company_name STRING, company_ticker STRING, company_is_delisted BOOLEAN,"
    " company_category STRING, company_currency STRING, company_location STRING,"
    " company_exchange_name STRING, company_region_name STRING,"
    " company_industry_name STRING, company_industry_sector STRING,"
    " company_sic_industry STRING, company_sic_sector STRING"
)
SILVER_CANDLES = _struct(
    "company_ticker STRING, candle_volume BIGINT, candle_volume_weighted DOUBLE,"
    " candle_open DOUBLE, candle_close DOUBLE, candle_high DOUBLE, candle_low DOUBLE,"
    " candle_time_stamp TIMESTAMP, candle_num_of_trades BIGINT, candle_is_otc BOOLEAN"
)
SILVER_NEWS = _struct(
    "news_title STRING, news_url STRING, news_time_published STRING,"
    " news_authors STRINGS, news_summary STRING, news_source STRING,"
    " news_overall_sentiment_score DOUBLE, news_overall_sentiment_label STRING,"
    " news_ticker STRING, news_company_relevance_score DOUBLE,"
    " news_company_ticker_sentiment_score DOUBLE,"
    " news_company_ticker_sentiment_label STRING, topic_name STRING,"
    " news_topic_relevance_score DOUBLE"
)

SILVER_ARTICLES = T.StructType(
    SILVER_NEWS.fields[:8]
    + _struct(
        "ticker_sentiment MENTIONS, topics TOPICS",
        MENTIONS=T.ArrayType(
            _struct(
                "ticker STRING, relevance_score DOUBLE, ticker_sentiment_score DOUBLE,"
                " ticker_sentiment_label STRING"
            )
        ),
        TOPICS=T.ArrayType(_struct("topic STRING, relevance_score DOUBLE")),
    ).fields
)

# Gold ------------------------------------------------------------------------

DIM_TIME = _struct(
    "time_key BIGINT, time_date DATE, time_day_of_week STRING, time_month STRING,"
    " time_quarter STRING, time_year INT"
)
DIM_COMPANIES = T.StructType(
    [T.StructField("company_key", T.LongType())]
    + SILVER_COMPANIES.fields
    + [T.StructField("company_update_time_stamp", T.TimestampType())]
)
DIM_TOPICS = _struct("topic_key BIGINT, topic_name STRING")
DIM_NEWS = _struct(
    "news_key BIGINT, news_title STRING, news_url STRING, news_time_published STRING,"
    " news_authors STRINGS, news_summary STRING, news_source STRING,"
    " news_overall_sentiment_score DOUBLE, news_overall_sentiment_label STRING,"
    " news_time_key BIGINT"
)
FACT_CANDLES = T.StructType(
    [T.StructField("candle_key", T.LongType()),
     T.StructField("candle_company_key", T.LongType())]
    + SILVER_CANDLES.fields[1:]
    + [T.StructField("candle_time_key", T.LongType())]
)
FACT_NEWS_COMPANIES = _struct(
    "news_company_key BIGINT, news_company_company_key BIGINT,"
    " news_company_news_key BIGINT, news_company_relevance_score DOUBLE,"
    " news_company_ticker_sentiment_score DOUBLE,"
    " news_company_ticker_sentiment_label STRING"
)
FACT_NEWS_TOPICS = _struct(
    "news_topic_key BIGINT, news_topic_news_key BIGINT, news_topic_topic_key BIGINT,"
    " news_topic_relevance_score DOUBLE"
)

SOURCE_TABLES = {
    "regions": REGIONS,
    "industries": INDUSTRIES,
    "sic_industries": SIC_INDUSTRIES,
    "exchanges": EXCHANGES,
    "companies": SOURCE_COMPANIES,
}
WAREHOUSE_TABLES = {
    "dim_time": DIM_TIME,
    "dim_companies": DIM_COMPANIES,
    "dim_topics": DIM_TOPICS,
    "dim_news": DIM_NEWS,
    "fact_candles": FACT_CANDLES,
    "fact_news_companies": FACT_NEWS_COMPANIES,
    "fact_news_topics": FACT_NEWS_TOPICS,
}
# Each day of a fact is a partition of its own; dimensions are append-only.
PARTITIONS = {
    "fact_candles": "candle_time_key",
    "fact_news_companies": "dt",
    "fact_news_topics": "dt",
}
# Dimensions that lie in ranges of their key: the key, and how many keys a range has.
KEY_RANGES = {
    "dim_companies": ("company_key", 1 << 20),
    "dim_news": ("news_key", 1 << 20),
}
