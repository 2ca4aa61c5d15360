"""The SQL each query of ``queries.py`` must agree with, over the same whole tables."""

from __future__ import annotations

from stocklake.plans import checks

PLACES = """
    select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey
"""

MARKETS = f"""
    select case when s_acctbal < 9000 then n_name else '  ' end as region,
        s_name || ' , ' || case r_name when 'AMERICA' then 'NASDAQ' when 'EUROPE' then 'NYSE'
            else 'OTC' end as primary_exchanges,
        case when s_acctbal < 0 then '08:00' else '09:30' end as local_open,
        case when s_acctbal < 0 then '16:30' else '16:00' end as local_close
    from supplier join ({PLACES}) on s_nationkey = n_nationkey
"""

COMPANIES = f"""
    select c_name as name, 'C' || c_custkey as ticker,
        case r_name when 'AMERICA' then 'NASDAQ' when 'EUROPE' then 'NYSE' else 'OTC' end
            as exchange,
        case when c_acctbal > 9500 then chr(160) else c_mktsegment end as sector,
        n_name as industry, cast(c_nationkey as bigint) as sic, r_name as sic_sector,
        case when c_acctbal < 0 then 'EUR' else 'USD' end as currency,
        n_name || '; U.S.A' as location, c_acctbal > 5000 as is_delisted
    from customer join ({PLACES}) on c_nationkey = n_nationkey
"""

# Articles, their tickers and their topics as the landed payload has them, copies included.
LINES = """
    select *, 1 as version from lineitem
    union all select *, 1 from lineitem where l_quantity = 20
    union all select *, 2 from lineitem where l_quantity = 30
"""
ARTICLES = f"""
    select 'Order ' || l_orderkey as news_title, '/orders/' || l_orderkey || '/' || l_linenumber as news_url,
        case when l_quantity > 2 then strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') else 'n/a' end
            as news_time_published,
        'P' || l_partkey as news_authors, 'line ' || l_linenumber as news_summary,
        case when l_linestatus = 'O' then 'desk' else 'n/a' end as news_source,
        greatest(l_tax - 0.04::double, 0.0::double) as news_overall_sentiment_score,
        l_returnflag as news_overall_sentiment_label,
        l_quantity >= 10 as has_topics, l_discount > 0 as has_tickers,
        l_partkey, l_suppkey, l_discount, l_linestatus, version
    from ({LINES})
"""
TICKERS = f"""
    select a.*, 'n/a' as news_ticker, 0.0::double as news_company_relevance_score,
        0.0::double as news_company_ticker_sentiment_score,
        'n/a' as news_company_ticker_sentiment_label
    from ({ARTICLES}) a where not has_tickers
    union all
    select a.*, 'C' || l_partkey, l_discount, news_overall_sentiment_score,
        news_overall_sentiment_label from ({ARTICLES}) a where has_tickers
    union all
    select a.*, case version when 1 then 'S' else 'X' end || l_suppkey, l_discount,
        news_overall_sentiment_score, news_overall_sentiment_label
    from ({ARTICLES}) a where has_tickers
"""


def topics_of(rows: str) -> str:
    return f"""
    select t.*, 'n/a' as topic_name, 0.0::double as news_topic_relevance_score
    from ({rows}) t where not has_topics
    union all
    select t.*, case version when 1 then news_overall_sentiment_label else 'more' end, l_discount
    from ({rows}) t where has_topics
    union all
    select t.*, l_linestatus, 0.0::double from ({rows}) t where has_topics
"""


SILVER_NEWS = f"""
    select distinct news_title, news_url, news_time_published, news_authors, news_summary,
        news_source, news_overall_sentiment_score, news_overall_sentiment_label,
        news_ticker, news_company_relevance_score, news_company_ticker_sentiment_score,
        news_company_ticker_sentiment_label, topic_name, news_topic_relevance_score
    from ({topics_of(TICKERS)})
"""
DIM_NEWS = f"""
    select row_number() over (order by news_title, news_url, news_time_published) as news_key,
        news_title, news_url, news_time_published, news_authors, news_summary, news_source,
        news_overall_sentiment_score, news_overall_sentiment_label,
        cast(7 as bigint) as news_time_key
    from (
        select *, row_number() over (
            partition by news_title, news_url, news_time_published
            order by news_authors, news_summary, news_source,
                news_overall_sentiment_score, news_overall_sentiment_label) as rn
        from ({ARTICLES}))
    where rn = 1
"""
TOPIC_ROWS = f"""
    select distinct news_title, news_url, news_time_published, topic_name,
        news_topic_relevance_score from ({topics_of(ARTICLES)})
"""
VERSIONS = """
    select 'S' || s_suppkey as ticker, s_acctbal as balance, s_suppkey as key from supplier
    union all
    select 'C' || c_custkey, c_acctbal, c_custkey + 1000000000 from customer
    where c_mktsegment <> 'FURNITURE'
"""
LATEST_COMPANIES = f"""
    select ticker, case when balance >= 0 then key + 1000000000000 else key end as company_key
    from ({VERSIONS})
"""
SILVER_CANDLES = """
    select 'C' || o_custkey as company_ticker,
        cast(case when o_orderstatus <> 'P' then trunc(o_totalprice) else 0 end as bigint)
            as candle_volume,
        case when o_orderstatus <> 'F' then o_totalprice else 0 end as candle_volume_weighted,
        o_totalprice as candle_open, o_totalprice + 1 as candle_close,
        o_totalprice + 2 as candle_high, o_totalprice - 1 as candle_low,
        date_trunc('second', o_orderdate + to_milliseconds(o_orderkey)) as candle_time_stamp,
        case when o_orderstatus <> 'O' then o_custkey else 0 end as candle_num_of_trades,
        o_orderpriority = '5-LOW' as candle_is_otc
    from (select * from orders union all select * from orders where o_orderstatus = 'P')
"""
NORMALISED_COMPANIES = f"""
    select distinct e.exchange_id as company_exchange_id, i.industry_id as company_industry_id,
        sic as company_sic_id, name as company_name, ticker as company_ticker,
        is_delisted as company_is_delisted, 'Common Stock' as company_category,
        currency as company_currency, location as company_location
    from ({COMPANIES}) c
    join (select exchange, row_number() over (order by exchange) as exchange_id
          from (select distinct exchange from ({COMPANIES}) where exchange <> 'OTC')) e
        on e.exchange = c.exchange
    join (select industry, sector, row_number() over (order by industry, sector) as industry_id
          from (select distinct industry, sector from ({COMPANIES}) where sector <> chr(160))) i
        on i.industry = c.industry and i.sector = c.sector
    where currency = 'USD'
"""

COMPANY_SNAPSHOT = """
    select c_name as company_name, 'C' || c_custkey as company_ticker,
        c_acctbal > 5000 as company_is_delisted, c_mktsegment as company_category,
        case when c_acctbal < 0 then 'EUR' else 'USD' end as company_currency,
        cast(null as varchar) as company_location, 'X ' || x.n_name as company_exchange_name,
        r.r_name as company_region_name, i.n_name as company_industry_name,
        'S ' || i.n_regionkey as company_industry_sector, s.r_name as company_sic_industry,
        lower(s.r_name) as company_sic_sector
    from customer
    left join nation x on x.n_nationkey = c_nationkey
    left join region r on r.r_regionkey = case when x.n_nationkey >= 5 then x.n_regionkey end
    left join nation i on c_acctbal >= 0 and i.n_nationkey = c_nationkey
    left join region s on c_acctbal <= 9000 and s.r_regionkey = c_custkey % 7
"""

def windows(cap: int) -> str:
    """Every event with the window of a feed of at most so many rows."""
    return f"""
    with e as (
        select event_id, ts, cast(ts as date) as base_date,
            case when strftime(ts, '%H:%M') <= '12:00' then 2 else 3 end as half from events),
    n as (
        select *, count(*) over (partition by base_date) as day_n,
            count(*) over (partition by base_date, half) as half_n,
            count(*) over (partition by base_date, hour(ts)) as hour_n from e),
    g as (
        select base_date, case when max(day_n) < {cap} then 1 when max(half_n) < {cap} then 2
            when max(hour_n) < {cap} then 4 else 5 end as grain from n group by base_date)
    select event_id, ts, e.base_date, cast(case when grain = 2 then half else grain end as int) as time_zone,
        case when grain = 1 or grain = 2 and half = 2 then date_trunc('day', ts)
            when grain = 2 then date_trunc('day', ts) + interval 721 minutes
            when grain = 4 then date_trunc('hour', ts) else date_trunc('minute', ts) end
            ::timestamp as window_start
    from e join g on g.base_date = e.base_date"""


# The tables of the constraint report, by the columns they have; all others are null.
CHECKED = {
    "regions": "select cast(r_regionkey as bigint) as region_id, r_name as region_name from region",
    "industries": """
        select cast(n_nationkey as bigint) as industry_id, n_name as industry_name,
            'S ' || n_regionkey as industry_sector from nation""",
    "sic_industries": """
        select r_regionkey as sic_id, r_name as sic_industry, lower(r_name) as sic_sector from region""",
    "exchanges": """
        select n_nationkey as exchange_id, case when n_nationkey >= 5 then n_regionkey end as exchange_region_id,
            'X ' || n_name as exchange_name from nation""",
    "companies": """
        select c_name as company_name, 'C' || c_custkey as company_ticker, c_acctbal > 5000 as company_is_delisted,
            c_mktsegment as company_category, case when c_acctbal < 0 then 'EUR' else 'USD' end as company_currency,
            c_nationkey as company_exchange_id, case when c_acctbal >= 0 then c_nationkey end as company_industry_id,
            case when c_acctbal <= 9000 then c_custkey % 7 end as company_sic_id from customer""",
    "dim_time": "select distinct quarter(o_orderdate) as time_key from orders where quarter(o_orderdate) < 4",
    "dim_companies": """
        select c_custkey as company_key, 'C' || c_custkey as company_ticker, c_acctbal > 5000 as company_is_delisted,
            case when c_acctbal >= 0 then 'USD' end as company_currency, c_mktsegment as company_region_name
        from customer where c_mktsegment <> 'FURNITURE'""",
    "fact_candles": """
        select o_orderkey // 2 as candle_key, o_custkey as candle_company_key,
            cast(floor(o_totalprice * 10000) as bigint) as candle_volume,
            case when o_orderstatus <> 'P' then o_custkey end as candle_num_of_trades,
            o_totalprice as candle_volume_weighted, o_totalprice as candle_open, o_totalprice as candle_close,
            o_totalprice as candle_high, o_totalprice as candle_low, quarter(o_orderdate) as candle_time_key
        from orders""",
}
NULL_COLUMNS = {
    "regions": ["region_local_open", "region_local_close"],
    "companies": ["company_id", "company_location"],
    "dim_time": ["time_date"],
}


def constraints() -> str:
    """One query per declared rule that the tables take part in."""
    ctes, rules = [], []
    for name, sql in CHECKED.items():
        nulls = "".join(f", null as {c}" for c in NULL_COLUMNS.get(name, []))
        ctes.append(f"{name} as (select *{nulls} from ({sql}))")

    def rule(table: str, name: str, count: str) -> None:
        if table in CHECKED:
            rules.append(f"select '{table}' as table_name, '{name}' as rule, ({count}) as n")

    for table, columns in checks.NOT_NULL.items():
        for c in columns:
            rule(table, f"not null {c}", f"select count(*) from {table} where {c} is null")
    for table, keys in checks.UNIQUE:
        k = ", ".join(keys)
        known = " and ".join(f"{c} is not null" for c in keys)
        groups = f"select 1 from {table} where {known} group by {k} having count(*) > 1"
        rule(table, f"unique {k}", f"select count(*) from ({groups})")
    for table, c, to, key in checks.FOREIGN:
        if to in CHECKED:
            known = f"select {key} from {to} where {key} is not null"
            rule(table, f"{c} in {to}", f"select count(*) from {table} where {c} is not null and {c} not in ({known})")
    for (table, c), size in checks.MAX_LENGTH.items():
        rule(table, f"length of {c}", f"select count(*) from {table} where length({c}::varchar) > {size}")
    for table, c in checks.INTEGERS:
        low, high = checks.INT_RANGE
        rule(table, f"integer {c}", f"select count(*) from {table} where {c} not between {low} and {high}")
    return f"with {', '.join(ctes)} select * from ({' union all '.join(rules)}) where n > 0"


ORACLES = {
    "roundtrip_json_array": """
        select * from orders""",
    "roundtrip_jsonl": "select * from part",
    "roundtrip_parquet_partition": """
        select *, cast(ts as date) as dt from events
        where cast(ts as date) <> date '2024-01-15' or event_type = 'click'""",
    "daily_partition_scan": """
        select event_id, user_id, value from events where cast(ts as date) = date '2024-01-15'""",
    "fetched_again": """
        select case when o_orderkey % 3 <> 0 then 2 else 1 end as fetch, o_orderkey as key,
            case when o_orderkey % 3 <> 0 then o_totalprice + 1 else o_totalprice end as price
        from orders where o_orderkey % 5 <> 0 or o_orderkey % 3 <> 0""",
    "unnest_envelope": """
        select 'part' as kind, l_partkey as key from lineitem
        union all select 'supplier', l_suppkey from lineitem""",
    "event_properties": """
        select cast(json_extract(props, '$.k') as int) as k, count(*) as n from events group by 1""",
    "capped_window_fetch": f"select * exclude (ts) from ({windows(150)})",
    "windows_below_a_minute": f"""
        with w as (select * from ({windows(2)})),
        p as (
            select event_id, window_start, level, (epoch_us(ts) - epoch_us(window_start)) * (1::bigint << level)
                // 60000000 as part
            from (select *, unnest(generate_series(0, 26)) as level from w where time_zone = 5)),
        d as (
            select event_id, case when bool_or(n >= 2) then least(max(level) filter (n >= 2) + 1, 26) end as halvings
            from (select *, count(*) over (partition by window_start, level, part) as n from p) group by event_id)
        select w.event_id, case when d.halvings is null then time_zone else 6 end as time_zone,
            case when d.halvings is null then w.window_start else w.window_start + to_microseconds(
                (part * 60000000 + (1::bigint << d.halvings) - 1) // (1::bigint << d.halvings)) end as window_start,
            coalesce(d.halvings, 0)::int as halvings
        from w left join d on d.event_id = w.event_id
        left join p on p.event_id = w.event_id and p.level = d.halvings""",
    "export_json": """
        select to_json(struct_pack(o_custkey := o_custkey,
            o_orderdate := strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S GMT'),
            o_orderkey := o_orderkey, o_orderpriority := o_orderpriority,
            o_orderstatus := o_orderstatus, o_totalprice := o_totalprice))::varchar as json_row
        from orders""",
    "pretty_documents": "select * from supplier",
    "split_documents": """
        select o_orderkey, o_totalprice,
            '}, {"' || o_orderstatus || '\\" ][' || o_orderpriority as note from orders""",
    "latest_document": "select * from nation",
    "rejected_payloads": """
        select case o_orderkey % 7 when 0 then 'broken' when 1 then 'no array' else 'sound' end
            as reason, count(*) as n_payloads from orders group by 1""",
    "http_date": """
        select o_orderkey, strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S GMT') as http_date
        from orders""",
    "table_counts": " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows from {t}"
        for t in ("customer", "supplier", "part", "orders", "lineitem", "events", "documents")
    ),
    "footer_bounds": """
        select count(*) as n_rows, min(o_orderkey) as min_o_orderkey, max(o_orderkey) as max_o_orderkey,
            min(o_custkey) as min_o_custkey, max(o_custkey) as max_o_custkey,
            min(o_totalprice) as min_o_totalprice, max(o_totalprice) as max_o_totalprice from orders""",
    "dim_projection": """
        select c_custkey as company_key, c_name as company_name,
            c_mktsegment as company_industry_name from customer""",
    "clean_rows": """
        select distinct p_brand as brand, p_type as part_type from part where p_size > 10""",
    "bad_cast_to_default": """
        select doc_id, coalesce(nullif(trim(source), ''), 'n/a') as source,
            coalesce(try_cast(lang as double), 0.0::double) as score,
            cast(greatest(n_chars - 500, 0) as double) as excess from documents""",
    "point_lookup": """
        select o_orderkey, o_custkey, o_totalprice, time_key from (
            select *, dense_rank() over (order by cast(o_orderdate as date)) as time_key
            from orders) where time_key = 42""",
    "filter_isin_eq": """
        select s_suppkey, n_name, r_name from supplier
        join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        where r_name in ('ASIA', 'EUROPE')""",
    "left_join_dropna": """
        select c_custkey, c_mktsegment, c_nationkey, dim_key from customer
        join (select s_nationkey, min(s_suppkey) as dim_key from supplier group by 1)
            on c_nationkey = s_nationkey where c_mktsegment = 'BUILDING'""",
    "denormalise_companies": f"""
        select c_name, c_mktsegment, n_name, r_name from customer
        left join (select * from ({PLACES}) where r_name <> 'AFRICA')
            on c_nationkey = n_nationkey""",
    "left_join_filter_equals_inner": """
        select o_orderkey, c_custkey from orders join customer on o_custkey = c_custkey
        where c_acctbal < 0""",
    "new_topics_not_in": """
        select distinct p_brand || ' ' || p_type as topic_name from part
        where p_brand || ' ' || p_type not in
            (select p_brand || ' ' || p_type from part where p_size <= 10)""",
    "dim_time_if_absent": """
        select distinct cast(o_orderdate as date) as time_date from orders
        where not exists (
            select 1 from lineitem where l_returnflag = 'R' and l_quantity > 40
                and cast(l_shipdate as date) = cast(o_orderdate as date))""",
    "full_row_dedup": """
        select distinct o_orderstatus, o_orderpriority, cast(o_orderdate as date) as o_date
        from orders""",
    "latest_keep_last": """
        select user_id, arg_max(event_type, event_id) as event_type, max(event_id) as event_id
        from events group by user_id""",
    "latest_by_row_number": """
        select user_id, event_id, event_type from (
            select *, row_number() over (
                partition by user_id order by cast(ts as date) desc, event_id desc) as rn
            from events) where rn = 1""",
    "surrogate_keys": """
        select 1000 + row_number() over (order by o_orderpriority, o_orderdate, o_orderkey)
            as order_key, o_orderpriority, o_orderkey from orders""",
    "union_sources": """
        select c_custkey as k, c_name as n from customer
        union all select s_suppkey, s_name from supplier""",
    "insert_ignore": """
        select p_brand, p_type, p_partkey from (
            select *, row_number() over (
                partition by p_brand, p_type order by p_size > 10, p_partkey) as rn
            from part) where rn = 1""",
    "incremental_dimension": """
        with o as (
            select o_custkey, cast(o_orderdate as date) as o_day, o_orderkey,
                case when o_orderpriority[1] = '1' then 1 when o_orderpriority[1] <= '3' then 2 else 3 end as batch
            from orders)
        select row_number() over (order by batch, o_custkey, o_day) as day_key, o_custkey, o_day, o_orderkey
        from (select *, row_number() over (partition by o_custkey, o_day order by batch, o_orderkey) as rn from o)
        where rn = 1""",
    "current_companies": f"""
        select ticker as company_ticker,
            case when ticker[1] = 'C' and balance > 5000 then timestamp '2024-03-01 00:00:00'
                when balance >= 0 then timestamp '2024-02-01 00:00:00' else timestamp '2024-01-01 00:00:00' end
                as company_update_time_stamp,
            case when ticker[1] = 'C' and balance > 5000 then key - 1000000000 + 3000000000000
                when balance >= 0 then key + 1000000000000 else key end as company_key
        from ({VERSIONS})""",
    "append_snapshot": """
        select row_number() over (order by load_day, company_name) as company_key, * from (
            select s_name as company_name, date '2024-01-01' as load_day from supplier
            union all select c_name, date '2024-01-02' from customer)""",
    "split_explode": """
        select doc_id, unnest(string_split(text, ', ')) as item from documents""",
    "dim_time": """
        select row_number() over (order by d) as time_key, d as time_date,
            strftime(d, '%A') as time_day_of_week, strftime(d, '%B') as time_month,
            cast(quarter(d) as varchar) as time_quarter, cast(year(d) as int) as time_year
        from (select distinct cast(o_orderdate as date) as d from orders)""",
    "calendar_of_events": """
        select event_id, d as time_date, strftime(d, '%A') as time_day_of_week,
            strftime(d, '%B') as time_month, cast(quarter(d) as varchar) as time_quarter,
            cast(year(d) as int) as time_year
        from (select event_id, cast(ts as date) as d from events)""",
    "unique_violations": """
        select p_brand, p_type, count(*) as n_dup from part group by 1, 2 having count(*) > 1""",
    "fk_violations": """
        select o_orderkey, o_custkey from orders where o_custkey not in
            (select c_custkey from customer where c_mktsegment <> 'FURNITURE')""",
    "not_null_violations": """
        with x as (
            select c_name, c_nationkey from orders left join
                (select * from customer where c_acctbal < 0) on o_custkey = c_custkey)
        select 'c_name' as column_name, count(*) as n_null from x where c_name is null
        union all select 'c_nationkey', count(*) from x where c_nationkey is null""",
    "range_violations": """
        select o_orderkey, cast(floor(o_totalprice * 10000) as bigint) as candle_volume
        from orders where floor(o_totalprice * 10000) > 2147483647""",
    "constraint_report": constraints(),
    "normalise_regions": f"""
        select distinct region as region_name, local_open as region_local_open,
            local_close as region_local_close from ({MARKETS}) where trim(region) <> ''""",
    "normalise_industries": f"""
        select distinct industry as industry_name, sector as industry_sector
        from ({COMPANIES}) where sector <> chr(160)""",
    "normalise_sic": f"""
        select distinct sic as sic_id, industry as sic_industry, sic_sector from ({COMPANIES})""",
    "normalise_exchanges": f"""
        select cast(n_nationkey as bigint) as exchange_region_id, exchange_name from (
            select region, unnest(string_split(primary_exchanges, ', ')) as exchange_name
            from (select distinct region, primary_exchanges from ({MARKETS})))
        join nation on n_name = region""",
    "normalise_source_companies": NORMALISED_COMPANIES,
    "load_source_table": """
        select row_number() over (order by batch, industry_name, industry_sector)
            as industry_id, industry_name, industry_sector,
            timestamp '2024-01-01 00:00:00' as database_update_timestamp
        from (select p_brand as industry_name, p_type as industry_sector,
                min(case when p_size <= 10 then 1 else 2 end) as batch from part group by 1, 2)""",
    "company_snapshot": COMPANY_SNAPSHOT,
    "dim_companies_reloads": f"""
        with n as (select count(*) as n from customer)
        select row_number() over (order by company_ticker) as company_key, company_name,
            company_ticker, company_is_delisted, timestamp '2024-01-01 01:00:00' as loaded
        from ({COMPANY_SNAPSHOT})
        union all
        select n + row_number() over (order by company_ticker), company_name, company_ticker,
            company_is_delisted, timestamp '2024-01-02 01:00:00' from ({COMPANY_SNAPSHOT}), n""",
    "served_companies": f"""
        select to_json(struct_pack(company_exchange_name := company_exchange_name,
            company_industry_name := company_industry_name,
            company_industry_sector := company_industry_sector,
            company_is_delisted := company_is_delisted, company_key := company_key,
            company_name := company_name, company_sic_industry := company_sic_industry,
            company_sic_sector := company_sic_sector, company_ticker := company_ticker,
            company_update_time_stamp := 'Mon, 01 Jan 2024 00:00:00 GMT'))::varchar as json_row
        from (select row_number() over (order by company_ticker) as company_key, *
              from ({COMPANY_SNAPSHOT})) where company_key = 42""",
    "silver_ohlcs": f"select distinct * from ({SILVER_CANDLES})",
    "silver_news": SILVER_NEWS,
    "normalise_companies": f"""
        select distinct trim(name, ' ') as company_name, ticker as company_ticker,
            is_delisted as company_is_delisted, 'Common Stock' as company_category,
            currency as company_currency,
            regexp_replace(location, 'U\\.S\\.A', 'United States', 'g') as company_location,
            exchange as company_exchange_name, sic_sector as company_region_name,
            industry as company_industry_name, trim(sector, ' ') as company_industry_sector,
            industry as company_sic_industry, sic_sector as company_sic_sector
        from ({COMPANIES})""",
    "fact_candles": f"""
        select cast(7 as bigint) as key_day, cast(1 as bigint) as key_copies,
            company_key as candle_company_key, c.* exclude (company_ticker),
            cast(7 as bigint) as candle_time_key
        from (select distinct * from ({SILVER_CANDLES})) c
        join ({LATEST_COMPANIES}) on ticker = company_ticker""",
    "served_candles": f"""
        select company_key as candle_company_key, c.* exclude (company_ticker),
            cast(42 as bigint) as candle_time_key
        from (select distinct * from ({SILVER_CANDLES}) where not candle_is_otc) c
        join ({LATEST_COMPANIES}) on ticker = company_ticker""",
    "dim_news": DIM_NEWS,
    "served_news": f"""
        select news_key, news_title, news_url, news_time_published, news_overall_sentiment_score,
            news_overall_sentiment_label, news_time_key from ({DIM_NEWS}) where news_key = 42""",
    "dim_news_compat": f"""
        select news_title, count(*) as n_copies from ({SILVER_NEWS}) group by 1""",
    "dim_topics": f"""
        select row_number() over (order by topic_name not in ('R', 'F'), topic_name)
            as topic_key, topic_name from (select distinct topic_name from ({TOPIC_ROWS}))""",
    "fact_news_topics": f"""
        select cast(7 as bigint) as key_day, cast(1 as bigint) as key_copies, news_key as news_topic_news_key, topic_key as news_topic_topic_key,
            news_topic_relevance_score
        from ({TOPIC_ROWS}) join ({DIM_NEWS}) using (news_title, news_url, news_time_published)
        join (select topic_name, row_number() over (order by topic_name) as topic_key
              from (select distinct topic_name from ({TOPIC_ROWS}))) using (topic_name)""",
    "fact_news_topics_either": f"""
        with a as ({ARTICLES}),
        known_topics as (
            select topic_name, row_number() over (order by topic_name) as topic_key
            from (select distinct topic_name
                  from ({topics_of("select * from a where news_overall_sentiment_label = 'A'")}))),
        known_news as (
            select news_title, news_url, news_time_published, row_number() over (
                order by news_title, news_url, news_time_published) as news_key
            from (select distinct news_title, news_url, news_time_published from a
                  where news_overall_sentiment_label = 'R'))
        select news_key as news_topic_news_key, topic_key as news_topic_topic_key,
            news_topic_relevance_score
        from ({TOPIC_ROWS}) left join known_topics using (topic_name)
        left join known_news using (news_title, news_url, news_time_published)
        where news_key is not null or topic_key is not null""",
    "fact_news_topics_compat": f"""
        with s as ({SILVER_NEWS})
        select f.news_title, f.topic_name, f.news_topic_relevance_score, count(*) as n_rows
        from s f join s d on d.news_title = f.news_title group by 1, 2, 3""",
    "fact_news_companies": f"""
        select cast(7 as bigint) as key_day, cast(1 as bigint) as key_copies, company_key as news_company_company_key, news_key as news_company_news_key,
            news_company_relevance_score, news_company_ticker_sentiment_score,
            news_company_ticker_sentiment_label
        from (select distinct news_title, news_url, news_time_published, news_ticker,
                news_company_relevance_score, news_company_ticker_sentiment_score,
                news_company_ticker_sentiment_label from ({TICKERS}))
        join ({DIM_NEWS}) using (news_title, news_url, news_time_published)
        join ({LATEST_COMPANIES}) on ticker = news_ticker""",
    "fact_news_companies_compat": f"""
        with s as ({SILVER_NEWS})
        select f.news_title, company_key, f.news_company_relevance_score, count(*) as n_rows
        from s f join s d on d.news_title = f.news_title
        join ({LATEST_COMPANIES}) on ticker = f.news_ticker group by 1, 2, 3""",
    "export_warehouse": f"""
        with companies as (
            select ticker, industry, row_number() over (order by ticker) as company_key from ({COMPANIES})
            where currency = 'USD' and sector <> chr(160) and exchange <> 'OTC' and exchange in (
                select unnest(string_split(primary_exchanges, ', ')) from ({MARKETS}) where trim(region) <> '')),
        news as (select * exclude (news_time_key) from ({DIM_NEWS})),
        topic_rows as (select distinct * from ({TOPIC_ROWS})),
        topics as (
            select topic_name, row_number() over (order by topic_name) as topic_key
            from (select distinct topic_name from topic_rows))
        select 'dim_time' as table_name, 1 as a, null::bigint as b, 'Thu, 29 Feb 2024 00:00:00 GMT' as s,
            'Thursday' as t, null::double as x, null::double as y
        union all select 'dim_companies', company_key, null, ticker, industry, null, null from companies
        union all select 'dim_topics', topic_key, null, topic_name, null, null, null from topics
        union all select 'dim_news', news_key, 1, news_url, news_time_published, news_overall_sentiment_score, null from news
        union all select 'fact_candles', company_key, 1, strftime(candle_time_stamp, '%a, %d %b %Y %H:%M:%S GMT'),
            candle_is_otc::varchar, candle_open, candle_volume
        from (select distinct * from ({SILVER_CANDLES})) join companies on ticker = company_ticker
        union all select 'fact_news_companies', company_key, news_key, news_company_ticker_sentiment_label, null,
            news_company_relevance_score, news_company_ticker_sentiment_score
        from (select distinct news_title, news_url, news_time_published, news_ticker, news_company_relevance_score,
                news_company_ticker_sentiment_score, news_company_ticker_sentiment_label from ({TICKERS}))
        join news using (news_title, news_url, news_time_published) join companies on ticker = news_ticker
        union all select 'fact_news_topics', news_key, topic_key, null, null, news_topic_relevance_score, null
        from topic_rows join news using (news_title, news_url, news_time_published) join topics using (topic_name)""",
    "warehouse_profile": f"""
        with companies as (
            select * from ({COMPANIES}) where currency = 'USD' and sector <> chr(160)
                and exchange <> 'OTC' and exchange in (
                    select unnest(string_split(primary_exchanges, ', ')) from ({MARKETS})
                    where trim(region) <> '')),
        articles as (select distinct news_title, news_url, news_time_published from ({ARTICLES}))
        select 'dim_time' as table_name, 1 as n_rows
        union all select 'dim_companies', count(*) from companies
        union all select 'dim_topics', count(distinct topic_name) from ({TOPIC_ROWS})
        union all select 'dim_news', count(*) from articles
        union all select 'fact_candles', count(*) from (select distinct * from ({SILVER_CANDLES}))
            where company_ticker in (select ticker from companies)
        union all select 'fact_news_companies', count(*) from (
            select distinct news_title, news_url, news_time_published, news_ticker,
                news_company_relevance_score, news_company_ticker_sentiment_score,
                news_company_ticker_sentiment_label from ({TICKERS}))
            where news_ticker in (select ticker from companies)
        union all select 'fact_news_topics', count(*) from ({TOPIC_ROWS})""",
}
