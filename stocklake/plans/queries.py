"""One query per operator over the given tables; ``oracles.py`` has the SQL to match."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklake import schemas
from stocklake.functions import (
    calendar_columns,
    clamp_scores,
    default_text,
    http_date,
)
from stocklake.operators import (
    CurrentVersions,
    absent_from,
    append_snapshot,
    assign_keys,
    clean_rows,
    column_bounds,
    dedup_rows,
    denormalise,
    file_counts,
    fk_violations,
    halve_minutes,
    insert_ignore,
    label_windows,
    latest_by,
    latest_versions,
    load_dimension,
    lookup,
    not_in,
    not_null_violations,
    range_violations,
    split_explode,
    unique_violations,
)
from stocklake.plans import checks, daily, gold, serving, silver, source_db
from stocklake.plans import standins as given
from stocklake.plans.standins import table
from stocklake.session import stage, staging_path
from stocklake.sources import (
    PACKED,
    append_key_ranges,
    append_table,
    candle_envelope,
    candles_from_text,
    export_rows,
    latest_file,
    merge_fetches,
    read_json_array,
    read_json_lines,
    read_partition,
    read_split_array,
    read_table,
    rejected_payloads,
    union_sources,
    unnest_envelope,
    write_days,
    write_json_array,
    write_json_lines,
    write_partition,
)

REGISTERED = {}


def query(fn):
    """Register under the function's name, without the ``q_`` that avoids a clash."""
    REGISTERED[fn.__name__.removeprefix("q_")] = fn
    return fn


# Sources and sinks -----------------------------------------------------------


@query
def roundtrip_json_array(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders")
    path = staging_path(spark, "json-array")
    write_json_array(rows, path)
    return read_json_array(spark, path, rows.schema, one_document_per_line=True)


@query
def roundtrip_jsonl(spark, sf):
    rows = table(spark, sf, "part")
    path = staging_path(spark, "jsonl")
    write_json_lines(rows, path)
    return read_json_lines(spark, path, rows.schema)


def _events_by_day(spark, sf):
    events = table(spark, sf, "events")
    path = staging_path(spark, "events")
    write_days(events.withColumn("dt", F.to_date("ts")), path)
    return path, events.schema


@query
def roundtrip_parquet_partition(spark, sf):
    """Write all days, then replace one of them by its clicks only."""
    path, schema = _events_by_day(spark, sf)
    day = read_partition(spark, path, "2024-01-15", schema)
    clicks = table(spark, sf, "events").where(
        (F.to_date("ts") == F.lit(datetime.date(2024, 1, 15)))
        & (F.col("event_type") == "click")
    )
    write_partition(clicks.select(*schema.names), path, "2024-01-15")
    return spark.read.schema(day.schema).parquet(path)


@query
def daily_partition_scan(spark, sf):
    path, schema = _events_by_day(spark, sf)
    day = read_partition(spark, path, "2024-01-15", schema)
    return day.select("event_id", "user_id", "value")


def _land_documents(rows: DataFrame, number: Column, folder: str) -> None:
    """Pretty documents, a file each, of the rows with the same number."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    records = rows.select(number.alias("document"), record.alias("record"))
    array = F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]"))
    documents = records.groupBy("document").agg(array.alias("value"))
    documents.write.mode("append").partitionBy("document").text(folder)


@query
def pretty_documents(spark, sf):
    """Suppliers as array documents of up to 100 records, and back."""
    rows = table(spark, sf, "supplier")
    folder = staging_path(spark, "documents")
    _land_documents(rows, F.floor(F.col("s_suppkey") / 100), folder)
    return read_json_array(spark, f"{folder}/*", rows.schema)


@query
def split_documents(spark, sf):
    """Orders as documents of up to 50,000 nested records with brackets and quotes in their
    texts; a document is read by as many tasks as it has splits."""
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    note = F.concat(F.lit('}, {"'), "o_orderstatus", F.lit('\\" ]['), "o_orderpriority")
    record = F.to_json(F.struct(key, F.struct(F.col("o_totalprice"), note.alias("note")).alias("more")))
    rows = orders.select(F.floor(key / 200_000).alias("document"), key, record.alias("value"))
    order = Window.partitionBy("document").orderBy("o_orderkey")
    head = F.when(F.row_number().over(order) == 1, "[").otherwise(",")
    foot = F.when(F.lead("o_orderkey").over(order).isNull(), "]").otherwise("")
    lines = rows.withColumn("value", F.concat(head, "value", foot)).sortWithinPartitions("document", "o_orderkey")
    folder = staging_path(spark, "documents")
    lines.drop("o_orderkey").write.partitionBy("document").text(folder)
    read = read_split_array(
        spark, f"{folder}/*", "o_orderkey BIGINT, more STRUCT<o_totalprice: DOUBLE, note: STRING>"
    )
    return read.select("o_orderkey", "more.*")


@query
def latest_document(spark, sf):
    """The nations' document lands after many of suppliers; the newest one is read."""
    suppliers, nations = table(spark, sf, "supplier"), table(spark, sf, "nation")
    folder = staging_path(spark, "documents")
    _land_documents(suppliers, F.floor(F.col("s_suppkey") / 100), folder)
    _land_documents(nations, F.lit(-1), folder)
    newest = latest_file(spark, f"{folder}/*", "txt").first()["path"]
    return read_json_array(spark, newest, nations.schema)


@query
def q_rejected_payloads(spark, sf):
    """Candle payloads of which some are cut short and some are error reports."""
    key = F.col("o_orderkey")
    whole = F.concat(F.lit('{"results": [{"T": "C'), "o_custkey", F.lit('", "t": "'), key, F.lit('"}]}'))
    landed = table(spark, sf, "orders").select(
        F.when(key % 7 == 0, F.substring(whole, F.lit(1), F.length(whole) - 2))
        .when(key % 7 == 1, '{"error": "limit reached"}')
        .otherwise(whole)
        .alias("value")
    )
    rejected = rejected_payloads(landed, "results", candle_envelope())
    sound = candles_from_text(landed, skip_rejected=True).agg(F.count("*").alias("n_payloads"))
    return rejected.unionByName(sound.withColumn("reason", F.lit("sound")))


@query
def fetched_again(spark, sf):
    """Orders fetched twice, each time without some of them and the second time at another
    price; a third fetch was cut short."""
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")

    def fetched(number: int, rows: DataFrame, price: Column) -> DataFrame:
        record = F.struct(key.alias("key"), price.alias("price"))
        payload = F.to_json(F.struct(F.array(record).alias("results")))
        return rows.select(F.lit(number).alias("fetch"), payload.alias("value"))

    first = fetched(1, orders.where(key % 5 != 0), F.col("o_totalprice"))
    second = fetched(2, orders.where(key % 3 != 0), F.col("o_totalprice") + 1)
    third = fetched(3, orders, F.col("o_totalprice") + 2)
    cut = third.withColumn("value", F.expr("substring(value, 1, length(value) - 3)"))
    landed = union_sources(first, second, cut)
    return merge_fetches(landed, "results", "struct<results: array<struct<key: bigint, price: double>>>", ["key"])


@query
def q_unnest_envelope(spark, sf):
    """Order lines as payload texts of two records each, and back to rows."""
    line = table(spark, sf, "lineitem")
    records = F.array(
        F.struct(F.lit("part").alias("kind"), F.col("l_partkey").alias("key")),
        F.struct(F.lit("supplier").alias("kind"), F.col("l_suppkey").alias("key")),
    )
    payload = F.struct(F.lit("OK").alias("status"), records.alias("results"))
    texts = line.select(F.to_json(payload).alias("value"))
    envelope = "struct<status: string, results: array<struct<kind: string, key: bigint>>>"
    return unnest_envelope(texts, "results", envelope)


@query
def event_properties(spark, sf):
    props = F.from_json("props", "k INT")["k"]
    events = table(spark, sf, "events").select(props.alias("k"))
    return events.groupBy("k").agg(F.count("*").alias("n"))


@query
def capped_window_fetch(spark, sf):
    """Every event with the window a feed of at most 150 rows is asked for."""
    labelled = label_windows(table(spark, sf, "events").select("event_id", "ts"), "ts", cap=150)
    start = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return labelled.select("event_id", "base_date", "time_zone", start)


@query
def windows_below_a_minute(spark, sf):
    """Every event with its window under a cap of one row, so minutes of two are cut."""
    labelled = halve_minutes(table(spark, sf, "events").select("event_id", "ts"), "ts", cap=2)
    start = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return labelled.select("event_id", "time_zone", start, "halvings")


@query
def export_json(spark, sf):
    """Orders with their date in HTTP form and their price."""
    return export_rows(table(spark, sf, "orders"))


@query
def q_http_date(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", http_date(F.col("o_orderdate")).alias("http_date"))


@query
def q_table_counts(spark, sf):
    names = ["customer", "supplier", "part", "orders", "lineitem", "events", "documents"]
    return file_counts(spark, {name: f"{sf}/{name}.parquet" for name in names})


@query
def footer_bounds(spark, sf):
    """Rows and extremes of the orders, from the footers alone."""
    return column_bounds(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


# Projections and filters -------------------------------------------------------


@query
def dim_projection(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("company_key"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("company_industry_name"),
    )


@query
def q_clean_rows(spark, sf):
    part = table(spark, sf, "part")
    kind = (
        F.when(F.col("p_size") <= 5, " \t")
        .when(F.col("p_size") <= 10, "\u00a0")
        .otherwise(F.col("p_type"))
    )
    return clean_rows(part.select(F.col("p_brand").alias("brand"), kind.alias("part_type")))


@query
def bad_cast_to_default(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "source", F.col("lang").alias("score"), (F.col("n_chars") - 500).alias("excess")
    )
    return default_text(clamp_scores(docs, ["score", "excess"]), ["source"])


@query
def point_lookup(spark, sf):
    """The orders of one day, asked for by its time key."""
    orders = table(spark, sf, "orders").withColumn("time_date", F.to_date("o_orderdate"))
    dim = gold.build_dim_time(orders, given.empty(spark, schemas.DIM_TIME))
    keyed = lookup(orders, dim, {"time_date": "time_date"}, ["time_key"], "inner")
    return serving.point_lookup(keyed, "time_key", "42").select(
        "o_orderkey", "o_custkey", "o_totalprice", "time_key"
    )


# Joins -------------------------------------------------------------------------


@query
def filter_isin_eq(spark, sf):
    supplier = table(spark, sf, "supplier")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    with_nation = lookup(
        supplier, nation, {"s_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"], "inner"
    )
    joined = lookup(
        with_nation,
        table(spark, sf, "region"),
        {"n_regionkey": "r_regionkey"},
        ["r_name"],
        "inner",
    )
    return joined.where(F.col("r_name").isin("ASIA", "EUROPE")).select(
        "s_suppkey", "n_name", "r_name"
    )


@query
def left_join_dropna(spark, sf):
    """Customers and the suppliers' nations on a composite key, complete rows only."""
    homes = (
        table(spark, sf, "supplier")
        .groupBy("s_nationkey")
        .agg(F.min("s_suppkey").alias("dim_key"))
        .withColumn("segment", F.lit("BUILDING"))
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    joined = lookup(
        customer,
        homes,
        {"c_nationkey": "s_nationkey", "c_mktsegment": "segment"},
        ["dim_key"],
    )
    return joined.na.drop("any")


@query
def denormalise_companies(spark, sf):
    """Customers with nation and region names; nations of Africa are left out."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    outside = absent_from(
        nation.withColumnRenamed("n_regionkey", "r_regionkey"),
        region.where(F.col("r_name") == "AFRICA"),
        "r_regionkey",
    )
    customer = table(spark, sf, "customer").select("c_name", "c_mktsegment", "c_nationkey")
    dims = [
        (outside, {"c_nationkey": "n_nationkey"}, ["n_name", "r_regionkey"]),
        (
            region.withColumnRenamed("r_regionkey", "key"),
            {"r_regionkey": "key"},
            ["r_name"],
        ),
    ]
    return denormalise(customer, dims).select("c_name", "c_mktsegment", "n_name", "r_name")


@query
def left_join_filter_equals_inner(spark, sf):
    in_debt = table(spark, sf, "customer").where("c_acctbal < 0")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    joined = lookup(
        orders, in_debt.withColumn("owner", F.col("c_custkey")), {"o_custkey": "c_custkey"}, ["owner"]
    )
    return joined.where(F.col("owner").isNotNull()).select(
        "o_orderkey", F.col("owner").alias("c_custkey")
    )


@query
def new_topics_not_in(spark, sf):
    names = F.concat_ws(" ", "p_brand", "p_type").alias("topic_name")
    part = table(spark, sf, "part")
    known = part.where("p_size <= 10").select(names)
    return not_in(dedup_rows(part.select(names)), known, "topic_name")


@query
def dim_time_if_absent(spark, sf):
    """Days with orders on which nothing was shipped."""
    ordered = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("time_date"))
    line = table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity > 40")
    shipped = line.select(F.to_date("l_shipdate").alias("time_date"))
    return absent_from(dedup_rows(ordered), shipped, "time_date")


# Distinct, latest, keys ----------------------------------------------------------


@query
def full_row_dedup(spark, sf):
    orders = table(spark, sf, "orders")
    return dedup_rows(
        orders.select(
            "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("o_date")
        )
    )


@query
def latest_keep_last(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id")
    return latest_by(events, ["user_id"], ["event_id"])


@query
def latest_by_row_number(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", F.to_date("ts").alias("day")
    )
    return latest_versions(events, ["user_id"], ["day", "event_id"]).drop("day")


@query
def surrogate_keys(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    order = ["o_orderpriority", "o_orderdate", "o_orderkey"]
    return assign_keys(orders, order, "order_key", start=1000).drop("o_orderdate")


@query
def q_union_sources(spark, sf):
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    return union_sources(
        customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n")),
        supplier.select(F.col("s_name").alias("n"), F.col("s_suppkey").alias("k")),
    )


@query
def q_insert_ignore(spark, sf):
    """Load small parts, then all others on top, one per brand and type."""
    part = table(spark, sf, "part").select("p_brand", "p_type", "p_partkey")
    sizes = table(spark, sf, "part")
    small = sizes.where("p_size <= 10").select(*part.columns)
    large = sizes.where("p_size > 10").select(*part.columns)
    conflict = ["p_brand", "p_type"]
    loaded = insert_ignore(small, part.limit(0), conflict, ["p_partkey"])
    return loaded.unionAll(insert_ignore(large, loaded, conflict, ["p_partkey"]))


@query
def incremental_dimension(spark, sf):
    """Customers' days with orders, in three loads by priority of which the last holds all;
    keys known from before are found in the index beside the dimension."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("o_day"), "o_orderkey", "o_orderpriority"
    )
    schema = T.StructType([T.StructField("day_key", T.LongType()), *orders.drop("o_orderpriority").schema.fields])
    path, urgent = staging_path(spark, "days"), F.col("o_orderpriority").substr(1, 1).cast("int")
    for batch in (orders.where(urgent == 1), orders.where(urgent <= 3), orders):
        load_dimension(batch, path, schema, "day_key", ["o_custkey", "o_day"], buckets=16)
    return read_table(spark, path, schema)


@query
def current_companies(spark, sf):
    """Three loads of companies, each with fewer of them under new keys, merged one after
    the other into the table of current ones."""
    first = given.dim_companies(spark, sf).select("company_ticker", "company_update_time_stamp", "company_key")
    richest = table(spark, sf, "customer").where("c_acctbal > 5000 and c_mktsegment <> 'FURNITURE'").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("company_ticker"),
        given.stamp("2024-03-01").alias("company_update_time_stamp"),
        (F.col("c_custkey") + 3_000_000_000_000).alias("company_key"),
    )
    current = CurrentVersions(
        spark, staging_path(spark, "current"), first.schema, ["company_ticker"], ["company_update_time_stamp", "company_key"]
    )
    for load in (first.where("company_key < 1000000000000"), first.where("company_key >= 1000000000000"), richest):
        current.merge(load)
    stamp = F.col("company_update_time_stamp").cast("timestamp_ntz")
    return current.frame().withColumn("company_update_time_stamp", stamp)


@query
def q_append_snapshot(spark, sf):
    """Suppliers as the first snapshot, customers appended after them."""
    supplier = table(spark, sf, "supplier").select(F.col("s_name").alias("company_name"))
    customer = table(spark, sf, "customer").select(F.col("c_name").alias("company_name"))
    columns = "company_key BIGINT, company_name STRING, load_day DATE"

    def snapshot(rows, target, day):
        defaults = {"load_day": F.lit(datetime.date.fromisoformat(day))}
        return append_snapshot(rows, target, "company_key", ["company_name"], defaults)

    first = snapshot(supplier, given.empty(spark, columns), "2024-01-01")
    return first.unionAll(snapshot(customer, first, "2024-01-02"))


# Text and arrays -----------------------------------------------------------------


@query
def q_split_explode(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return split_explode(docs, "text", ", ", out="item")


@query
def dim_time(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("time_date"))
    return gold.build_dim_time(days, given.empty(spark, schemas.DIM_TIME))


@query
def calendar_of_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("time_date"))
    return calendar_columns(events, "time_date")


# Constraint checks -----------------------------------------------------------------


@query
def q_unique_violations(spark, sf):
    return unique_violations(table(spark, sf, "part"), ["p_brand", "p_type"])


@query
def q_fk_violations(spark, sf):
    parent = table(spark, sf, "customer").where("c_mktsegment <> 'FURNITURE'")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return fk_violations(orders, parent, "o_custkey", "c_custkey")


@query
def q_not_null_violations(spark, sf):
    customer = table(spark, sf, "customer").where("c_acctbal < 0")
    orders = lookup(
        table(spark, sf, "orders"),
        customer,
        {"o_custkey": "c_custkey"},
        ["c_name", "c_nationkey"],
    )
    return not_null_violations(orders, ["o_orderkey", "c_name", "c_nationkey"])


@query
def q_range_violations(spark, sf):
    volumes = table(spark, sf, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") * 10000).alias("candle_volume")
    )
    return range_violations(volumes, "candle_volume", -(2**31), 2**31 - 1)


def _checked_tables(spark, sf) -> dict[str, DataFrame]:
    """Tables that break many of the declared rules: the source tables below, companies of
    which some are left out, and orders as candles, two to a key, with volumes beyond an
    integer. Columns that the given tables have nothing for are null."""
    customer, price = table(spark, sf, "customer"), F.col("o_totalprice")
    companies = customer.where("c_mktsegment <> 'FURNITURE'").select(
        F.col("c_custkey").alias("company_key"),
        F.concat(F.lit("C"), F.col("c_custkey")).alias("company_ticker"),
        (F.col("c_acctbal") > 5000).alias("company_is_delisted"),
        F.when(F.col("c_acctbal") >= 0, "USD").alias("company_currency"),
        F.col("c_mktsegment").alias("company_region_name"),
    )
    candles = table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 2).alias("candle_key"),
        F.col("o_custkey").alias("candle_company_key"),
        F.floor(price * 10000).alias("candle_volume"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("candle_num_of_trades"),
        *[price.alias(f"candle_{c}") for c in ("volume_weighted", "open", "close", "high", "low")],
        F.quarter("o_orderdate").cast("long").alias("candle_time_key"),
    )
    days = table(spark, sf, "orders").select(F.quarter("o_orderdate").cast("long").alias("time_key"))
    made = {**_source_tables(spark, sf), "dim_companies": companies, "fact_candles": candles}
    made["dim_time"] = days.where("time_key < 4").distinct()
    all_schemas = {**schemas.SOURCE_TABLES, **schemas.WAREHOUSE_TABLES}
    return {
        name: df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in all_schemas[name].fields if f.name not in df.columns])
        for name, df in made.items()
    }


@query
def constraint_report(spark, sf):
    """All declared rules over eight tables, each scanned once."""
    return checks.constraint_report(_checked_tables(spark, sf))


# Source tables ----------------------------------------------------------------------


@query
def normalise_regions(spark, sf):
    return source_db.normalise_regions(given.markets(spark, sf))


@query
def normalise_industries(spark, sf):
    return source_db.normalise_industries(given.companies(spark, sf))


@query
def normalise_sic(spark, sf):
    return source_db.normalise_sic(given.companies(spark, sf))


@query
def normalise_exchanges(spark, sf):
    regions = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("region_id"), F.col("n_name").alias("region_name")
    )
    return source_db.normalise_exchanges(given.markets(spark, sf), regions)


def _industries(spark, sf):
    rows = source_db.normalise_industries(given.companies(spark, sf))
    return assign_keys(rows, ["industry_name", "industry_sector"], "industry_id")


def _exchanges(spark, sf):
    """The suppliers' desks and the two big exchanges, in one list."""
    listed = given.companies(spark, sf).where(F.col("exchange") != "OTC")
    names = dedup_rows(listed.select(F.col("exchange").alias("exchange_name")))
    return assign_keys(names, ["exchange_name"], "exchange_id")


@query
def normalise_source_companies(spark, sf):
    return source_db.normalise_companies(
        given.companies(spark, sf), _exchanges(spark, sf), _industries(spark, sf)
    )


@query
def load_source_table(spark, sf):
    """Two batches of industries into one keyed table; the second holds the first."""
    part = table(spark, sf, "part").select(
        F.col("p_brand").alias("industry_name"),
        F.col("p_type").alias("industry_sector"),
        "p_size",
    )
    path = staging_path(spark, "industries")
    for batch in (part.where("p_size <= 10"), part):
        loaded = source_db.load_table(
            spark,
            batch.drop("p_size"),
            path,
            "industries",
            ["industry_name", "industry_sector"],
            given.stamp("2024-01-01"),
            "industry_id",
        )
    stamp = F.col("database_update_timestamp").cast("timestamp_ntz")
    return loaded.withColumn("database_update_timestamp", stamp)


def _source_tables(spark, sf) -> dict[str, DataFrame]:
    """Customers as source companies: exchanges and industries by nation, SIC by number.

    Some companies have no industry or SIC id, some an id that no table has, and some
    exchanges no region.
    """
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    customer, key = table(spark, sf, "customer"), F.col("c_nationkey").cast("long")
    balance = F.col("c_acctbal")
    return {
        "companies": customer.select(
            F.col("c_name").alias("company_name"),
            F.concat(F.lit("C"), F.col("c_custkey")).alias("company_ticker"),
            (balance > 5000).alias("company_is_delisted"),
            F.col("c_mktsegment").alias("company_category"),
            F.when(balance < 0, "EUR").otherwise("USD").alias("company_currency"),
            F.lit(None).cast("string").alias("company_location"),
            key.alias("company_exchange_id"),
            F.when(balance >= 0, key).alias("company_industry_id"),
            F.when(balance <= 9000, F.col("c_custkey") % 7).alias("company_sic_id"),
        ),
        "exchanges": nation.select(
            F.col("n_nationkey").cast("long").alias("exchange_id"),
            F.when(F.col("n_nationkey") >= 5, F.col("n_regionkey")).cast("long").alias("exchange_region_id"),
            F.concat(F.lit("X "), F.col("n_name")).alias("exchange_name"),
        ),
        "regions": region.select(
            F.col("r_regionkey").cast("long").alias("region_id"), F.col("r_name").alias("region_name")
        ),
        "industries": nation.select(
            F.col("n_nationkey").cast("long").alias("industry_id"),
            F.col("n_name").alias("industry_name"),
            F.concat(F.lit("S "), F.col("n_regionkey")).alias("industry_sector"),
        ),
        "sic_industries": region.select(
            F.col("r_regionkey").alias("sic_id"),
            F.col("r_name").alias("sic_industry"),
            F.lower("r_name").alias("sic_sector"),
        ),
    }


@query
def company_snapshot(spark, sf):
    return source_db.company_snapshot(**_source_tables(spark, sf))


@query
def dim_companies_reloads(spark, sf):
    """Loads of one day at two hours, then of the next: the repeated one adds nothing."""
    rows = source_db.company_snapshot(**_source_tables(spark, sf))
    path = staging_path(spark, "dim-companies")
    given.empty(spark, schemas.DIM_COMPANIES).write.parquet(path)
    for at in ("2024-01-01 01:00:00", "2024-01-01 05:00:00", "2024-01-02 01:00:00"):
        loaded = read_table(spark, path, schemas.DIM_COMPANIES)
        append_table(gold.build_dim_companies(rows, loaded, F.lit(at).cast("timestamp")), path)
    stamp = F.col("company_update_time_stamp").cast("timestamp_ntz")
    return (
        read_table(spark, path, schemas.DIM_COMPANIES)
        .select("company_key", "company_name", "company_ticker", "company_is_delisted", stamp.alias("loaded"))
    )


@query
def served_companies(spark, sf):
    """One company by its key, with the served columns, as exported JSON."""
    loaded = gold.build_dim_companies(
        source_db.company_snapshot(**_source_tables(spark, sf)),
        given.empty(spark, schemas.DIM_COMPANIES),
        given.stamp("2024-01-01"),
    )
    return export_rows(serving.serve({"dim_companies": loaded}, "dim_companies", company_key=" 42 "))


# Silver -------------------------------------------------------------------------------


@query
def silver_ohlcs(spark, sf):
    candles = silver.silver_candles(candles_from_text(given.candle_payloads(spark, sf)))
    return candles.withColumn(
        "candle_time_stamp", F.col("candle_time_stamp").cast("timestamp_ntz")
    )


#: Rows per landed file; compressed ones are read by one task each.
FILE_ROWS = 100_000

#: Bronze tables landed beforehand, by application and folder of the given tables.
_LANDED: dict[tuple[str, str], str] = {}


def land_news(spark: SparkSession, sf: str) -> str:
    """Write the stand-in articles as a bronze table of many files, as payloads land; the
    given table is one file of few row groups, which few tasks could read. The number of
    files follows the rows, and none is shuffled."""
    path = staging_path(spark, "bronze-news")
    landed = given.news(spark, sf).write.option("maxRecordsPerFile", FILE_ROWS)
    landed.option("compression", "zstd").parquet(path)
    return path


def land_beforehand(spark: SparkSession, sf: str) -> None:
    """Land the articles now, for all queries of this application: ``bench.py`` times
    landing on its own. Otherwise each query lands what it reads."""
    _LANDED[spark.sparkContext.applicationId, sf] = land_news(spark, sf)


def _bronze_news(spark, sf):
    """The articles as the bronze table the jobs read."""
    path = _LANDED.get((spark.sparkContext.applicationId, sf)) or land_news(spark, sf)
    return read_table(spark, path, schemas.NEWS)


def _silver_articles(spark, sf):
    """The distinct articles as the silver table that gold reads."""
    return stage(silver.silver_articles(_bronze_news(spark, sf)), "silver-articles")


@query
def silver_news(spark, sf):
    rows = silver.silver_news(_bronze_news(spark, sf))
    return rows.withColumn("news_authors", F.array_join("news_authors", "|"))


@query
def q_normalise_companies(spark, sf):
    """Untidy company texts from customers and their places."""
    source = given.companies(spark, sf)
    untidy = {c: F.concat(F.lit(" "), F.col(c), F.lit("  ")) for c in ("name", "sector")}
    rows = source.withColumns(untidy).select(
        F.col("name").alias("company_name"),
        F.col("ticker").alias("company_ticker"),
        F.col("isDelisted").alias("company_is_delisted"),
        F.col("category").alias("company_category"),
        F.col("currency").alias("company_currency"),
        F.col("location").alias("company_location"),
        F.col("exchange").alias("company_exchange_name"),
        F.col("sicSector").alias("company_region_name"),
        F.col("industry").alias("company_industry_name"),
        F.col("sector").alias("company_industry_sector"),
        F.col("sicIndustry").alias("company_sic_industry"),
        F.col("sicSector").alias("company_sic_sector"),
    )
    return silver.silver_companies(rows)


# Gold ----------------------------------------------------------------------------------


@query
def fact_candles(spark, sf):
    candles = silver.silver_candles(candles_from_text(given.candle_payloads(spark, sf)))
    companies = gold.latest_companies(given.dim_companies(spark, sf))
    facts = gold.build_fact_candles(candles, companies, 7)
    return facts.withColumn(
        "candle_time_stamp", F.col("candle_time_stamp").cast("timestamp_ntz")
    ).select(*_key_checks("candle_key"), "*").drop("candle_key")


@query
def served_candles(spark, sf):
    """Facts of two days as the daily run writes them; one day is served by its key."""
    candles = silver.silver_candles(candles_from_text(given.candle_payloads(spark, sf)))
    companies = gold.latest_companies(given.dim_companies(spark, sf))
    path, column = staging_path(spark, "fact-candles"), schemas.PARTITIONS["fact_candles"]
    for key, day in ((41, candles.where("candle_is_otc")), (42, candles.where("not candle_is_otc"))):
        write_partition(gold.build_fact_candles(day, companies, key), path, key, column)
    facts = read_table(spark, path, schemas.FACT_CANDLES)
    served = serving.serve({"fact_candles": facts}, "fact_candles", candle_time_key="42")
    stamp = F.col("candle_time_stamp").cast("timestamp_ntz")
    return served.withColumn("candle_time_stamp", stamp).drop("candle_key")


def _key_checks(key: str) -> list[Column]:
    """What a load's keys promise: the day above bit 40, and no key twice."""
    copies = F.count("*").over(Window.partitionBy(key))
    return [F.shiftright(key, 40).alias("key_day"), copies.alias("key_copies")]


def _dim_news(spark, sf, articles):
    return gold.build_dim_news(articles, given.empty(spark, schemas.DIM_NEWS), 7)


def _dim_topics(spark, topics):
    return gold.build_dim_topics(topics, given.empty(spark, schemas.DIM_TOPICS))


@query
def dim_news(spark, sf):
    rows = _dim_news(spark, sf, _silver_articles(spark, sf))
    return rows.withColumn("news_authors", F.array_join("news_authors", "|"))


@query
def served_news(spark, sf):
    """One article by its key, from a dimension that lies in ranges of keys."""
    path = staging_path(spark, "dim-news")
    append_key_ranges(_dim_news(spark, sf, _silver_articles(spark, sf)), path, *schemas.KEY_RANGES["dim_news"])
    return serving.serve_key(spark, path, "dim_news", " 42 ")


@query
def dim_news_compat(spark, sf):
    """How many article rows a load without deduplication would write per title."""
    (rows,) = silver.news_copies(_bronze_news(spark, sf), None)
    return rows.groupBy("news_title").agg(F.sum("copies").alias("n_copies"))


@query
def dim_topics(spark, sf):
    topics = silver.news_topics(_silver_articles(spark, sf))
    known = _dim_topics(spark, topics.where("topic_name in ('R', 'F')"))
    return known.unionAll(gold.build_dim_topics(topics, known))


@query
def fact_news_topics(spark, sf):
    articles = _silver_articles(spark, sf)
    dim = _dim_topics(spark, silver.news_topics(articles))
    keyed = gold.key_articles(articles, _dim_news(spark, sf, articles))
    facts = gold.build_fact_news_topics(silver.news_topics(keyed, by=["news_key"]), dim, 7)
    return facts.select(*_key_checks("news_topic_key"), "*").drop("news_topic_key")


@query
def fact_news_topics_either(spark, sf):
    """Only articles labelled R and topics of articles labelled A are known."""
    articles = _silver_articles(spark, sf)
    label = F.col("news_overall_sentiment_label")
    some_topics = silver.news_topics(articles.where(label == "A"))
    return gold.link_topics_either(
        silver.news_topics(articles),
        _dim_news(spark, sf, articles.where(label == "R")),
        _dim_topics(spark, some_topics),
    )


@query
def fact_news_topics_compat(spark, sf):
    topics, rows = silver.news_copies(_bronze_news(spark, sf), "topics", None)
    values = ["topic_name", "news_topic_relevance_score"]
    return gold.title_join_counts(topics, rows, values, "copies")


@query
def fact_news_companies(spark, sf):
    articles = _silver_articles(spark, sf)
    keyed = gold.key_articles(articles, _dim_news(spark, sf, articles))
    mentions = silver.news_mentions(keyed, by=["news_key"])
    companies = gold.latest_companies(given.dim_companies(spark, sf))
    facts = gold.build_fact_news_companies(mentions, companies, 7)
    return facts.select(*_key_checks("news_company_key"), "*").drop("news_company_key")


@query
def fact_news_companies_compat(spark, sf):
    mentions, rows = silver.news_copies(_bronze_news(spark, sf), "ticker_sentiment", None)
    known = lookup(
        mentions,
        gold.latest_companies(given.dim_companies(spark, sf)),
        {"news_ticker": "company_ticker"},
        ["company_key"],
        "inner",
    )
    values = ["company_key", "news_company_relevance_score"]
    return gold.title_join_counts(known, rows, values, "copies")


# Whole runs ----------------------------------------------------------------------------


def land_payloads(spark, sf, paths: daily.Paths, run_date: datetime.date) -> None:
    """The given tables as the payload files a daily run finds."""
    day = run_date - datetime.timedelta(days=1)
    for name, rows in (("markets", given.markets), ("companies", given.companies)):
        write_json_array(rows(spark, sf), f"{paths.landing(name)}/dt={run_date}")
    news = given.news(spark, sf).select(F.array(F.struct("*")).alias("feed"))
    packed = {**PACKED, "maxRecordsPerFile": FILE_ROWS}
    news.write.mode("overwrite").options(**packed).json(f"{paths.landing('news')}/dt={day}")
    candles = given.candle_payloads(spark, sf)
    candles.write.mode("overwrite").options(**packed).text(f"{paths.landing('ohlcs')}/dt={day}")


@query
def warehouse_profile(spark, sf):
    """Row counts of the star schema after a complete daily run over all tables."""
    paths = daily.Paths(staging_path(spark, "run"))
    run_date = datetime.date(2024, 3, 1)
    land_payloads(spark, sf, paths, run_date)
    daily.run_all(spark, run_date, paths, "2024-03-01 01:00:00")
    return serving.profile_files(spark, {name: paths.gold(name) for name in schemas.WAREHOUSE_TABLES})


#: Of each exported table: two keys, two texts and two numbers.
EXPORTED = {
    "dim_time": ("time_key", None, "time_date", "time_day_of_week", None, None),
    "dim_companies": ("company_key", None, "company_ticker", "company_industry_name", None, None),
    "dim_topics": ("topic_key", None, "topic_name", None, None, None),
    "dim_news": ("news_key", "news_time_key", "news_url", "news_time_published", "news_overall_sentiment_score", None),
    "fact_candles": (
        "candle_company_key", "candle_time_key", "candle_time_stamp", "candle_is_otc", "candle_open", "candle_volume"),
    "fact_news_companies": (
        "news_company_company_key", "news_company_news_key", "news_company_ticker_sentiment_label", None,
        "news_company_relevance_score", "news_company_ticker_sentiment_score"),
    "fact_news_topics": (
        "news_topic_news_key", "news_topic_topic_key", None, None, "news_topic_relevance_score", None),
}


EXPORTED_AS = {"a": "BIGINT", "b": "BIGINT", "s": "STRING", "t": "STRING", "x": "DOUBLE", "y": "DOUBLE"}


def read_exported(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Those columns of an exported table; each record is parsed once for all of them."""
    given_as = dict(zip(EXPORTED_AS, EXPORTED[name], strict=True))
    fields = [T.StructField(c, schemas.TYPES[EXPORTED_AS[k]]) for k, c in given_as.items() if c]
    columns = [(F.col(c) if c else F.lit(None).cast(EXPORTED_AS[k])).alias(k) for k, c in given_as.items()]
    rows = read_json_lines(spark, f"{out}/{name}", T.StructType(fields))
    return rows.select(F.lit(name).alias("table_name"), *columns)


@query
def export_warehouse(spark, sf):
    """Every row of the seven tables as a run leaves them and the export writes them."""
    paths = daily.Paths(staging_path(spark, "run"))
    run_date = datetime.date(2024, 3, 1)
    land_payloads(spark, sf, paths, run_date)
    daily.run_all(spark, run_date, paths, "2024-03-01 01:00:00")
    out = staging_path(spark, "export")
    serving.export_warehouse(daily.warehouse_tables(spark, paths), out)

    return union_sources(*[read_exported(spark, out, name) for name in EXPORTED])
