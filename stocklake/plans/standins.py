"""The given tables in the shape of the landed payloads and dimensions.

Every frame covers its whole table, so the work grows with the data. Gaps, blanks
and unknown keys are put in by value (a status, a balance), as real feeds have them.
Arrays are built within a row; nothing is gathered into groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklake import schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(col: str) -> Column:
    return F.col(col).cast("string")


def stamp(day: str) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp")


def places(spark, sf_dir) -> DataFrame:
    """Nations with the name of their region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def exchange_of(region: str) -> Column:
    name = F.col(region)
    return F.when(name == "AMERICA", "NASDAQ").when(name == "EUROPE", "NYSE").otherwise("OTC")


def markets(spark, sf_dir) -> DataFrame:
    """One market record per supplier: its nation, and two exchanges in its list."""
    supplier = table(spark, sf_dir, "supplier")
    at = places(spark, sf_dir)
    in_debt = F.col("s_acctbal") < 0
    return supplier.join(at, supplier.s_nationkey == at.n_nationkey).select(
        F.lit("Equity").alias("market_type"),
        F.when(F.col("s_acctbal") < 9000, F.col("n_name")).otherwise("  ").alias("region"),
        F.concat("s_name", F.lit(" , "), exchange_of("r_name")).alias("primary_exchanges"),
        F.when(in_debt, "08:00").otherwise("09:30").alias("local_open"),
        F.when(in_debt, "16:30").otherwise("16:00").alias("local_close"),
        F.lit("open").alias("current_status"),
        F.lit("").alias("notes"),
    )


def companies(spark, sf_dir) -> DataFrame:
    """One company record per customer."""
    customer = table(spark, sf_dir, "customer")
    at = places(spark, sf_dir)
    balance = F.col("c_acctbal")
    return customer.join(at, customer.c_nationkey == at.n_nationkey).select(
        F.col("c_name").alias("name"),
        F.concat(F.lit("C"), text("c_custkey")).alias("ticker"),
        exchange_of("r_name").alias("exchange"),
        F.when(balance > 9500, "\u00a0").otherwise(F.col("c_mktsegment")).alias("sector"),
        F.col("n_name").alias("industry"),
        text("c_nationkey").alias("sic"),
        F.col("r_name").alias("sicSector"),
        F.col("n_name").alias("sicIndustry"),
        F.lit("Common Stock").alias("category"),
        F.when(balance < 0, "EUR").otherwise("USD").alias("currency"),
        F.concat("n_name", F.lit("; U.S.A")).alias("location"),
        (balance > 5000).alias("isDelisted"),
    )


def landed_again(rows: DataFrame, versions: Column) -> DataFrame:
    """Each row as often as ``versions`` (an array) has items, with its ``version``."""
    return rows.select("*", F.explode(versions).alias("version"))


def news(spark, sf_dir) -> DataFrame:
    """One article per order line: up to two tickers and two topics each.

    Lines of quantity 20 land twice as they are, those of 30 again as a second version
    that shares one ticker and one topic with the first.
    """
    again = F.when(F.col("l_quantity") == 20, F.lit(1)).when(F.col("l_quantity") == 30, F.lit(2))
    versions = F.array_compact(F.array(F.lit(1), again))
    line = landed_again(table(spark, sf_dir, "lineitem"), versions)
    second = F.col("version") == 2
    published = F.date_format("l_shipdate", "yyyyMMdd'T'HHmmss")
    discount, quantity = text("l_discount"), F.col("l_quantity")
    sentiment = (F.col("l_tax") - 0.04).cast("string")

    def mention(prefix: str, key: str) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), text(key)).alias("ticker"),
            discount.alias("relevance_score"),
            sentiment.alias("ticker_sentiment_score"),
            F.col("l_returnflag").alias("ticker_sentiment_label"),
        )

    def topic(name: str, score: Column) -> Column:
        return F.struct(F.col(name).alias("topic"), score.alias("relevance_score"))

    own_topic = topic("l_linestatus", F.lit("x"))
    more_topic = F.struct(F.lit("more").alias("topic"), discount.alias("relevance_score"))
    mentions = F.when(second, F.array(mention("C", "l_partkey"), mention("X", "l_suppkey"))).otherwise(
        F.array(mention("C", "l_partkey"), mention("S", "l_suppkey"))
    )
    topics = F.when(second, F.array(own_topic, more_topic)).otherwise(
        F.array(topic("l_returnflag", discount), own_topic)
    )
    return line.select(
        F.concat(F.lit("Order "), text("l_orderkey")).alias("title"),
        F.concat_ws("/", F.lit("/orders"), "l_orderkey", "l_linenumber").alias("url"),
        F.when(quantity > 2, published).otherwise("soon").alias("time_published"),
        F.array(F.concat(F.lit("P"), text("l_partkey"))).alias("authors"),
        F.concat(F.lit(" line "), text("l_linenumber"), F.lit(" ")).alias("summary"),
        F.when(F.col("l_linestatus") == "O", F.lit("desk")).alias("source"),
        (F.col("l_tax") - 0.04).alias("overall_sentiment_score"),
        F.col("l_returnflag").alias("overall_sentiment_label"),
        F.lit(None).cast("string").alias("banner_image"),
        F.lit(None).cast("string").alias("source_domain"),
        F.lit("n/a").alias("category_within_source"),
        F.when(quantity >= 10, topics)
        .when(quantity >= 5, F.slice(topics, 1, 0))
        .alias("topics"),
        F.when(F.col("l_discount") > 0, mentions).alias("ticker_sentiment"),
    )


def candle_payloads(spark, sf_dir) -> DataFrame:
    """One payload text per order, its record with a field T and a field t; those of orders
    with status P land twice."""
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    record = {
        "T": F.concat(F.lit(" C"), text("o_custkey"), F.lit(" ")),
        "t": F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey"),
        "v": F.when(status != "P", price),
        "vw": F.when(status != "F", price),
        "o": price,
        "c": price + 1,
        "h": price + 2,
        "l": price - 1,
        "n": F.when(status != "O", F.col("o_custkey")),
        "otc": F.when(F.col("o_orderpriority") == "5-LOW", F.lit(True)),
    }
    pairs = [part for k, v in record.items() for part in (F.lit(k), v.cast("string"))]
    results = F.array(F.create_map(*pairs))
    payload = F.create_map(F.lit("results"), results)
    versions = F.array_compact(F.array(F.lit(1), F.when(status == "P", F.lit(2))))
    orders = landed_again(table(spark, sf_dir, "orders"), versions)
    return orders.select(F.to_json(payload).alias("value"))


def dim_companies(spark, sf_dir) -> DataFrame:
    """Two snapshots: everybody, then those with a balance under new keys.

    Suppliers have tickers S..., customers C...; customers in furniture are unknown.
    """
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.concat(F.lit("S"), text("s_suppkey")).alias("company_ticker"),
        F.col("s_acctbal").alias("balance"),
    )
    customer = (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") != "FURNITURE")
        .select(
            (F.col("c_custkey") + 1_000_000_000).alias("key"),
            F.concat(F.lit("C"), text("c_custkey")).alias("company_ticker"),
            F.col("c_acctbal").alias("balance"),
        )
    )
    first = supplier.unionAll(customer)
    second = first.where("balance >= 0").withColumn("key", F.col("key") + 1_000_000_000_000)
    rows = first.withColumn("at", stamp("2024-01-01")).unionAll(
        second.withColumn("at", stamp("2024-02-01"))
    )
    given = {
        "company_key": F.col("key"),
        "company_ticker": F.col("company_ticker"),
        "company_is_delisted": F.lit(False),
        "company_update_time_stamp": F.col("at"),
    }
    return rows.select(
        *[
            given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schemas.DIM_COMPANIES.fields
        ]
    )


def empty(spark, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
