"""Every registered query against its SQL, and what the plans must not hold."""

import re

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from stocklake.plans.queries import REGISTERED

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def conn():
    return connect(SF)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, conn, name):
    assert differences(QUERIES[name](spark, SF), conn, ORACLES[name]) is None


def test_every_query_has_sql():
    """Those of the corpus operators without SQL have tests of their own."""
    assert set(REGISTERED) <= set(ORACLES) <= set(QUERIES)


def test_plans_do_not_depend_on_the_size(spark):
    """No operator that only small or only large tables get, up to the join strategy."""
    small, large = (
        re.sub(r"\W+", " ", " ".join(re.findall(r"Exchange \w+|Window|Generate", plan_of(QUERIES[name](spark, sf)))))
        for name in ["fact_candles"]
        for sf in (SF, "/root/testdata/sf0.01")
    )
    assert "RoundRobin" not in small and "RoundRobin" not in large


def test_entry(spark):
    df = contract.entry(spark)
    assert {"news_company_company_key", "news_company_news_key"} < set(df.columns)
    assert df.count() > 0


HEAVY = [
    "silver_news", "silver_ohlcs", "fact_candles", "fact_news_topics", "fact_news_companies",
    "dim_news", "insert_ignore", "latest_keep_last", "latest_by_row_number",
    "capped_window_fetch", "new_topics_not_in", "clean_rows", "surrogate_keys",
]


@pytest.mark.parametrize("name", HEAVY)
def test_plan_stays_distributed(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit"):
        assert operator not in plan, operator
    # Only aggregates to one row, and the list of staged files, may meet in one task.
    single = [m.start() for m in re.finditer("Exchange SinglePartition", plan)]
    allowed = plan.count("Subquery") + plan.count("_file")
    assert len(single) <= allowed


def test_ranking_is_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["latest_by_row_number"](spark, SF))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_day_scan_prunes_partitions_and_columns(spark):
    df = QUERIES["daily_partition_scan"](spark, SF)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan_of(df)
    assert {path.split("/")[-2] for path in df.inputFiles()} == {"dt=2024-01-15"}


def test_served_day_is_one_partition(spark):
    df = QUERIES["served_candles"](spark, SF)
    assert re.search(r"PartitionFilters: \[isnotnull\(candle_time_key#\d+L\), \(candle_time_key#\d+L = 42\)\]", plan_of(df))


def test_compat_counts_build_no_pairs(spark):
    """Facts counted per title and value meet one staged count per title."""
    plan = plan_of(QUERIES["fact_news_topics_compat"](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert re.search(r"FileScan parquet \[news_title#\d+,_right#", plan)


def test_constraint_report_scans_each_table_once(spark):
    """Eight tables, eight scans, and no join."""
    plan = plan_of(QUERIES["constraint_report"](spark, SF))
    assert plan.count("FileScan") == 8 and "Join" not in plan


NEWS = ["silver_news", "dim_news_compat", "fact_news_topics_compat", "silver_ohlcs", "fact_candles"]


@pytest.mark.parametrize("name", NEWS)
def test_red_without_its_distinct(spark, conn, monkeypatch, name):
    """Copies land in every feed, so a job that forgets to drop them is found out."""
    from stocklake.operators import explode
    from stocklake.plans import silver

    monkeypatch.setattr(silver, "dedup_rows", lambda df: df)
    monkeypatch.setattr(explode, "_distinct_product", explode._explode_all)
    assert differences(QUERIES[name](spark, SF), conn, ORACLES[name]) is not None


def test_articles_are_read_from_bronze_once(spark):
    """What is built of the cleaned articles reads the staged table, not bronze."""
    for name in ("silver_news", "dim_news_compat", "fact_news_topics_compat", "dim_topics", "fact_news_topics"):
        files = {path.split("/")[-2].rsplit("-", 1)[0] for path in QUERIES[name](spark, SF).inputFiles()}
        assert files and "bronze-news" not in files, (name, files)


@pytest.mark.parametrize("name, pushed", [("table_counts", "COUNT(*)"), ("footer_bounds", "MIN(o_totalprice)")])
def test_counts_and_bounds_come_from_footers(spark, name, pushed):
    plan = plan_of(QUERIES[name](spark, SF))
    aggregations = re.findall(r"PushedAggregation: \[(.*?)\]", plan)
    assert aggregations and all("COUNT(*)" in a for a in aggregations) and any(pushed in a for a in aggregations)
