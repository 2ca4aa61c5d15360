"""The declared constraints of the source tables and the warehouse, as one report.

Parquet enforces none of them, so a load is checked after the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stocklake.operators.constraints import Rule, longest, not_null, reference, report, unique, within

# Columns that must be set.
NOT_NULL = {
    "regions": ["region_name", "region_local_open", "region_local_close"],
    "industries": ["industry_name", "industry_sector"],
    "sic_industries": ["sic_id", "sic_industry", "sic_sector"],
    "exchanges": ["exchange_region_id", "exchange_name"],
    "companies": [
        "company_exchange_id",
        "company_name",
        "company_ticker",
        "company_is_delisted",
    ],
    "dim_time": ["time_key", "time_date"],
    "dim_companies": [
        "company_key",
        "company_ticker",
        "company_is_delisted",
        "company_currency",
        "company_region_name",
    ],
    "dim_topics": ["topic_key", "topic_name"],
    "dim_news": [
        "news_key",
        "news_title",
        "news_url",
        "news_overall_sentiment_score",
        "news_overall_sentiment_label",
    ],
    "fact_candles": [
        "candle_key",
        "candle_company_key",
        "candle_volume",
        "candle_volume_weighted",
        "candle_open",
        "candle_close",
        "candle_high",
        "candle_low",
        "candle_num_of_trades",
    ],
    "fact_news_companies": [
        "news_company_company_key",
        "news_company_news_key",
        "news_company_relevance_score",
        "news_company_ticker_sentiment_score",
        "news_company_ticker_sentiment_label",
    ],
    "fact_news_topics": [
        "news_topic_news_key",
        "news_topic_topic_key",
        "news_topic_relevance_score",
    ],
}
# Primary keys and unique constraints.
UNIQUE = [
    ("regions", ["region_id"]),
    ("regions", ["region_name"]),
    ("industries", ["industry_id"]),
    ("industries", ["industry_name", "industry_sector"]),
    ("sic_industries", ["sic_id"]),
    ("sic_industries", ["sic_industry", "sic_sector"]),
    ("exchanges", ["exchange_id"]),
    ("exchanges", ["exchange_name"]),
    ("companies", ["company_id"]),
    ("companies", ["company_ticker", "company_is_delisted"]),
    ("dim_time", ["time_key"]),
    ("dim_companies", ["company_key"]),
    ("dim_topics", ["topic_key"]),
    ("dim_topics", ["topic_name"]),
    ("dim_news", ["news_key"]),
    ("fact_candles", ["candle_key"]),
]
# References.
FOREIGN = [
    ("exchanges", "exchange_region_id", "regions", "region_id"),
    ("companies", "company_exchange_id", "exchanges", "exchange_id"),
    ("companies", "company_industry_id", "industries", "industry_id"),
    ("companies", "company_sic_id", "sic_industries", "sic_id"),
    ("dim_news", "news_time_key", "dim_time", "time_key"),
    ("fact_candles", "candle_company_key", "dim_companies", "company_key"),
    ("fact_candles", "candle_time_key", "dim_time", "time_key"),
    ("fact_news_companies", "news_company_company_key", "dim_companies", "company_key"),
    ("fact_news_companies", "news_company_news_key", "dim_news", "news_key"),
    ("fact_news_topics", "news_topic_news_key", "dim_news", "news_key"),
    ("fact_news_topics", "news_topic_topic_key", "dim_topics", "topic_key"),
]
# Declared text lengths that the source database enforces.
MAX_LENGTH = {
    ("regions", "region_name"): 50,
    ("industries", "industry_name"): 200,
    ("industries", "industry_sector"): 200,
    ("sic_industries", "sic_industry"): 200,
    ("sic_industries", "sic_sector"): 200,
    ("exchanges", "exchange_name"): 50,
    ("companies", "company_name"): 200,
    ("companies", "company_ticker"): 50,
    ("companies", "company_category"): 200,
    ("companies", "company_currency"): 50,
    ("companies", "company_location"): 200,
}
# Columns declared INTEGER, and the range of that type.
INTEGERS = [("fact_candles", "candle_volume"), ("fact_candles", "candle_num_of_trades")]
INT_RANGE = (-(2**31), 2**31 - 1)


def declared_rules(tables) -> list[Rule]:
    """The rules about the given tables; a reference needs both of its tables."""
    rules = [not_null(t, c) for t, columns in NOT_NULL.items() for c in columns]
    rules += [unique(t, keys) for t, keys in UNIQUE]
    rules += [reference(*foreign) for foreign in FOREIGN]
    rules += [longest(t, c, size) for (t, c), size in MAX_LENGTH.items()]
    rules += [within(t, c, *INT_RANGE) for t, c in INTEGERS]
    return [rule for rule in rules if all(table in tables for table in rule.roles)]


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, rule, n`` for every declared rule that some rows break.

    Rules about tables that are not given are skipped. For a unique rule ``n`` counts
    the repeated keys, else the rows.
    """
    return report(tables, declared_rules(tables))
