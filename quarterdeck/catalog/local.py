"""Geography and local macro queries over places derived from nations, customers and orders.

Every row of the tables takes part. Gaps are planted as NULLs: counties of one region have no name, state or metro, one metro has no GDP,
one no rate, one no population, one a population of 0, and one metro's GDP comes under a code that nothing else knows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.functions import keys
from quarterdeck.functions.missing import to_number
from quarterdeck.operators import geo, series
from quarterdeck.plans.shapes import daily_series, table
from quarterdeck.session import materialize

METROS = """select cast(10000 + n_nationkey as varchar(10)) as cbsa_code, n_name as msa_name, lpad(cast(n_regionkey as varchar(5)), 2, '0') as state_fips, upper(substr(r_name, 1, 2)) as state_abbrev from {nation} join {region} on n_regionkey = r_regionkey"""
COUNTIES = """select r_name as region, lpad(cast(n_nationkey as varchar(5)), 5, '0') as fips, case when r_name <> 'AFRICA' then 'County ' || n_name end as county, case when r_name <> 'AFRICA' then upper(substr(r_name, 1, 2)) end as state, case when r_name <> 'AFRICA' then cast(10000 + n_nationkey as varchar(10)) end as cbsa_code from {nation} join {region} on n_regionkey = r_regionkey"""
XWALK = """select cast(c_custkey as varchar(20)) || '.0' as zip_code, cast(c_nationkey as varchar(20)) as geoid, cast(o_totalprice as varchar(30)) as residential_ratio, cast(c_acctbal as varchar(30)) as bus_ratio, cast(null as varchar(30)) as other_ratio, '0.5' as total_ratio, year(o_orderdate) as year, quarter(o_orderdate) as quarter, o_orderkey from {orders} join {customer} on o_custkey = c_custkey"""
ZIP_METRO = """select case when o_custkey > 99999 then cast(o_custkey as varchar(20)) else lpad(cast(o_custkey as varchar(20)), 5, '0') end as zip, case o_orderpriority when '1-URGENT' then '10001' when '2-HIGH' then '10002' when '3-MEDIUM' then '10003' when '4-NOT SPECIFIED' then '' else '10004' end as cbsa_code, cast(round(o_totalprice * 100) as bigint) / 50000000.0 as tot_ratio from {orders}"""
GDP = """select cast(case when c_nationkey = 11 then 20011 else 10000 + c_nationkey end as varchar(10)) as cbsa_code, cast(date_trunc('year', o_orderdate) as date) as date, cast(sum(case when c_nationkey <> 7 then cast(round(o_totalprice * 100) as bigint) end) as double) as value from {orders} join {customer} on o_custkey = c_custkey group by 1, 2"""
POPULATION = """select cast(10000 + c_nationkey as varchar(10)) as cbsa_code, cast(date_trunc('year', o_orderdate) as date) as date, case when c_nationkey = 9 then 0.0 when c_nationkey <> 12 then cast(count(*) * 1000 + 7 as double) end as value from {orders} join {customer} on o_custkey = c_custkey group by c_nationkey, 2"""
RATES = """select cast(10000 + c_nationkey as varchar(10)) as cbsa_code, cast(date_trunc('month', o_orderdate) as date) as date, case when c_nationkey <> 13 then cast(sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as double) * 8 / count(*) end as value from {orders} join {customer} on o_custkey = c_custkey group by c_nationkey, 2"""
REQUESTS = """select 'cbsa' as geo_type, cast(10000 + n_nationkey as varchar(20)) as geo_value from {nation} union all select 'cbsa', 'not a code' from {region}
 union all select 'zip', ' ' || cast(c_custkey as varchar(20)) from {customer} union all select 'county_fips', cast(c_nationkey as varchar(20)) from {customer} union all select 'state', lower(substr(r_name, 1, 2)) from {region}"""
NAMES = ["nation", "region", "customer", "orders"]


def shape(spark, sf, text):
    """Run a shape's text over the tables, passed by reference; no view is registered."""
    text = text.replace("varchar(10)", "string").replace("varchar(20)", "string").replace("varchar(30)", "string").replace("varchar(5)", "string")
    used = {n: table(spark, sf, n) for n in NAMES if f"{{{n}}}" in text}
    return spark.sql(text, **used)


def coverage(spark, sf):
    return geo.zip_coverage(shape(spark, sf, COUNTIES), shape(spark, sf, XWALK), ["o_orderkey"])


def states(spark, sf):
    return shape(spark, sf, METROS).select("state_abbrev", "state_fips").distinct()


def spine(spark, sf):
    best = geo.best_metro_per_zip(shape(spark, sf, ZIP_METRO))
    counties = shape(spark, sf, COUNTIES).select(F.col("fips").alias("county_fips"), "cbsa_code")
    return geo.build_spine(shape(spark, sf, REQUESTS), shape(spark, sf, METROS), best, counties, states(spark, sf))


def board(spark, sf):
    parts = (materialize(shape(spark, sf, t), "macro") for t in (GDP, RATES, POPULATION))
    return geo.board_latest(spine(spark, sf), *parts)


def rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def key_cleaners(spark, sf):
    raw = shape(spark, sf, XWALK)
    return raw.select(
        "o_orderkey",
        keys.zip5("zip_code").alias("zip"),
        keys.zip5(F.concat("zip_code", F.lit("-1234"))).alias("zip_plus4"),
        keys.fips5("geoid").alias("fips"),
        keys.period_code_date("year", F.concat(F.lit("M0"), F.col("quarter").cast("string"))).alias("period_date"),
        keys.period_code_date("year", F.lit("M13")).alias("annual_date"),
        to_number(F.concat(F.lit("1,"), F.lpad(F.col("quarter").cast("string"), 3, "0"))).alias("comma_number"),
    )


def zip_coverage(spark, sf):
    return coverage(spark, sf)


def zip_coverage_checks(spark, sf):
    """Checks that must find the planted faults: short codes, unknown and empty regions, an empty ratio."""
    cover = materialize(coverage(spark, sf), "coverage")
    short = cover.withColumn("zip", F.when(F.col("quarter") == 4, F.lit("123")).otherwise(F.col("zip")))
    regions = shape(spark, sf, "select r_name as region from {region} where r_name <> 'ASIA' union all select distinct 'NOWHERE' from {region}")
    summary = geo.zip_summary(cover)
    return geo.coverage_checks(short, summary, shape(spark, sf, COUNTIES), regions)


def best_metro_per_zip(spark, sf):
    return geo.best_metro_per_zip(shape(spark, sf, ZIP_METRO))


def attach_spine(spark, sf):
    return geo.attach_spine(shape(spark, sf, GDP), spine(spark, sf))


def zip_prefix_metro(spark, sf):
    prefixes = shape(spark, sf, "select lpad(cast(n_nationkey as string), 3, '0') as zip_prefix, n_name as metro from {nation}")
    zips = shape(spark, sf, XWALK).select("o_orderkey", keys.zip5("zip_code").alias("zip"))
    return geo.metro_by_zip_prefix(zips, prefixes)


def gdp_metrics(spark, sf):
    return rounded(geo.gdp_metrics(shape(spark, sf, GDP), shape(spark, sf, POPULATION)), "value", digits=3)


def invalid_population(spark, sf):
    return geo.invalid_population(shape(spark, sf, POPULATION))


def unemployment_metrics(spark, sf):
    return rounded(geo.unemployment_metrics(shape(spark, sf, RATES)), "value")


BOARD = ["cbsa_code", "msa_name", "state_abbrev", "mapping_method", "geo_level", "real_gdp_level", "real_gdp_yoy_pct", "population", "real_gdp_per_100k", "unemployment_rate", "unemployment_yoy_pp", "macro_stress_flag", "macro_data_completeness", "missing_sources"]


def stress_board(spark, sf):
    return rounded(geo.board_panel(board(spark, sf), BOARD, "real_gdp_level"), "real_gdp_yoy_pct", "real_gdp_per_100k", "unemployment_rate", "unemployment_yoy_pp", digits=4)


def top_metros(spark, sf):
    return geo.top_metros(board(spark, sf)).select("cbsa_code", "real_gdp_level")


def policy_quarter_agg(spark, sf):
    df = daily_series(spark, sf)
    families = F.when(F.col("SeriesID") < 30, "gdp").when(F.col("SeriesID") < 60, "unemployment").when(F.col("SeriesID") < 80, "population").otherwise("hpi")
    return rounded(series.quarterly_by_policy(df.withColumn("family", families)), "VALUE", digits=3)


QUERIES = {
    "key_cleaners": key_cleaners,
    "zip_coverage": zip_coverage,
    "zip_summary": lambda s, d: geo.zip_summary(coverage(s, d)),
    "zip_coverage_checks": zip_coverage_checks,
    "best_metro_per_zip": best_metro_per_zip,
    "spine_waterfall": spine,
    "attach_spine": attach_spine,
    "zip_prefix_metro": zip_prefix_metro,
    "gdp_metrics": gdp_metrics,
    "invalid_population": invalid_population,
    "unemployment_metrics": unemployment_metrics,
    "stress_board": stress_board,
    "top_metros": top_metros,
    "policy_quarter_agg": policy_quarter_agg,
}


def plain(text):
    for n in NAMES:
        text = text.replace(f"{{{n}}}", n)
    return text


for _name, _text in (("metros", METROS), ("counties", COUNTIES), ("xwalk", XWALK), ("zip_metro", ZIP_METRO), ("gdp", GDP), ("population", POPULATION), ("rates", RATES), ("requests", REQUESTS)):
    register(_name, plain(_text))
_ZIP = "(case when length(split_part(zip_code, '.', 1)) > 5 then split_part(zip_code, '.', 1) else lpad(split_part(zip_code, '.', 1), 5, '0') end)"
register(
    "coverage",
    f"""select r.region, {_ZIP} as zip, lpad(geoid, 5, '0') as county_fips, year, quarter, county, state, cast(residential_ratio as double) as res_ratio, cast(bus_ratio as double) as bus_ratio, cast(null as double) as oth_ratio, 0.5::double as tot_ratio
       from xwalk join counties r on lpad(geoid, 5, '0') = r.fips qualify row_number() over (partition by r.region, zip_code, geoid, year, quarter order by o_orderkey) = 1""",
    ("xwalk", "counties"),
)
register("best_zip", "select zip, cbsa_code, tot_ratio from zip_metro where trim(cbsa_code) <> '' qualify row_number() over (partition by zip order by tot_ratio desc, cbsa_code) = 1", ("zip_metro",))
register(
    "spine",
    """select geo_type as source_geo_type, geo_value as source_geo_value, case when method <> 'unmatched' then cbsa end as target_cbsa_code, case when method <> 'unmatched' then m.msa_name end as target_msa_name,
       case when method = 'county_to_cbsa' then left(geo_value, 2) when geo_type = 'state' then sf when method <> 'unmatched' then m.state_fips end as state_fips,
       case when geo_type = 'state' then geo_value when method <> 'unmatched' then m.state_abbrev end as state_abbrev, method as mapping_method,
       case method when 'unmatched' then 0.0::double when 'zip_to_cbsa' then tot_ratio else 1.0 end as mapping_weight, case method when 'unmatched' then 0.0::double when 'zip_to_cbsa' then tot_ratio else 1.0 end * 100 as coverage_pct,
       case method when 'direct_cbsa' then 'high' when 'zip_to_cbsa' then 'medium' when 'unmatched' then 'unmatched' else 'low' end as quality_flag
       from (select r.*, z.tot_ratio, s.state_fips as sf, coalesce(case when geo_type = 'cbsa' then geo_value end, z.cbsa_code, c.cbsa_code) as cbsa,
         case when geo_type = 'cbsa' and regexp_full_match(geo_value, '[0-9]{5}') then 'direct_cbsa' when geo_type = 'zip' and z.cbsa_code is not null then 'zip_to_cbsa' when geo_type = 'county_fips' and c.cbsa_code is not null then 'county_to_cbsa' when geo_type = 'state' then 'state_fallback' else 'unmatched' end as method
         from (select distinct geo_type, case when geo_type = 'state' then upper(trim(geo_value)) when length(trim(geo_value)) > 5 then trim(geo_value) else lpad(trim(geo_value), 5, '0') end as geo_value from requests) r
         left join best_zip z on geo_type = 'zip' and z.zip = geo_value left join counties c on geo_type = 'county_fips' and c.fips = geo_value
         left join (select distinct state_abbrev, state_fips from metros) s on geo_type = 'state' and s.state_abbrev = geo_value) left join metros m on cbsa = m.cbsa_code""",
    ("requests", "best_zip", "counties", "metros"),
)
register(
    "spine1",
    """select target_cbsa_code as cbsa_code, target_msa_name as msa_name, state_abbrev, mapping_method from spine where target_cbsa_code is not null
       qualify row_number() over (partition by target_cbsa_code order by case quality_flag when 'high' then 1 when 'medium' then 2 else 3 end, source_geo_type, source_geo_value) = 1""",
    ("spine",),
)
register("pop1", "select cbsa_code, max_by(value, date) as pop from population group by 1", ("population",))
register(
    "gdpm",
    """select *, (k / nullif(lag(k) over (partition by cbsa_code order by date), 0) - 1) * 100 as g from (
       select cbsa_code, date, value, case when pop > 0 then value / nullif(pop, 0) end as c, case when pop > 0 then value / nullif(pop, 0) * 100000.0 end as k,
       case when p.cbsa_code is null then 'missing' when pop > 0 then 'ok' else 'invalid' end as f from gdp left join pop1 p using (cbsa_code))""",
    ("gdp", "pop1"),
)
_QE = "cast(last_day(cast(date_trunc('quarter', date) as date) + interval 2 month) as date)"
register(
    "unemp",
    f"select *, v - lag(v, 4) over (partition by cbsa_code order by date) as pp from (select cbsa_code, {_QE} as date, avg(value) as v from rates where value is not null group by cbsa_code, {_QE})",
    ("rates",),
)
register(
    "board",
    """select s.cbsa_code, s.msa_name, s.state_abbrev, s.mapping_method, 'msa' as geo_level, g.l as real_gdp_level, g.y as real_gdp_yoy_pct, p.pop as population, m.k as real_gdp_per_100k, u.v as unemployment_rate, w.pp as unemployment_yoy_pp,
       case when coalesce(w.pp, 0) > 0.5 and coalesce(g.y, 0) < 0 then 'STRESS' when coalesce(w.pp, 0) > 0.5 or coalesce(g.y, 0) < 0 then 'WATCH' else 'OK' end as macro_stress_flag,
       case (g.l is null)::int + (p.pop is null)::int + (u.v is null)::int when 0 then 'complete' when 3 then 'none' else 'partial' end as macro_data_completeness,
       nullif(array_to_string(list_filter([case when g.l is null then 'gdp' end, case when p.pop is null then 'population' end, case when u.v is null then 'unemployment' end], lambda x: x is not null), ','), '') as missing_sources
       from spine1 s left join (select cbsa_code, max_by(value, date) as l, max_by(y, date) filter (y is not null) as y from (select *, (value / nullif(lag(value) over (partition by cbsa_code order by date), 0) - 1) * 100 as y from gdp) group by 1) g using (cbsa_code)
       left join pop1 p using (cbsa_code) left join (select cbsa_code, max_by(k, date) as k from gdpm where k is not null group by 1) m using (cbsa_code)
       left join (select cbsa_code, max_by(v, date) as v from unemp group by 1) u using (cbsa_code) left join (select cbsa_code, max_by(pp, date) as pp from unemp where pp is not null group by 1) w using (cbsa_code)""",
    ("spine1", "gdp", "pop1", "gdpm", "unemp"),
)
_FAM = "case when SeriesID < 30 then 'gdp' when SeriesID < 60 then 'unemployment' when SeriesID < 80 then 'population' else 'hpi' end"

ORACLES = {
    "key_cleaners": with_ctes(
        f"select o_orderkey, {_ZIP} as zip, {_ZIP} as zip_plus4, lpad(geoid, 5, '0') as fips, make_date(year, quarter, 1) as period_date, cast(null as date) as annual_date, cast(1000 + quarter as double) as comma_number from xwalk", "xwalk"
    ),
    "zip_coverage": with_ctes("select * from coverage", "coverage"),
    "zip_summary": with_ctes(
        "select region, count(distinct zip) as zip_count, count(distinct county_fips) as unique_county_count, max(year) as year, max(quarter) as quarter, coalesce(string_agg(distinct county, ', ' order by county), '') as counties, coalesce(string_agg(distinct state, ', ' order by state), '') as states from coverage group by 1", "coverage"
    ),
    "zip_coverage_checks": with_ctes(
        """select 'unknown_region' as rule, 'ERROR' as level, region as subject, count(*) as rows_affected from coverage where region not in (select r_name from region where r_name <> 'ASIA') group by region
           union all select 'zip_length', 'WARN', '', count(*) from short where length(zip) <> 5 having count(*) > 0
           union all select 'summary_mismatch', 'WARN', region, n from (select region, count(distinct zip) as z from coverage group by 1) join (select region, count(distinct zip) as n from short group by 1) using (region) where z <> n
           union all select 'region_without_zip', 'WARN', 'NOWHERE', 0
           union all select 'ratio_all_null', 'WARN', 'oth_ratio', count(*) from coverage""".replace("short", "(select region, case when quarter = 4 then '123' else zip end as zip from coverage)"),
        "coverage",
    ),
    "best_metro_per_zip": with_ctes("select * from best_zip", "best_zip"),
    "spine_waterfall": with_ctes("select * from spine", "spine"),
    "attach_spine": with_ctes("select cbsa_code, date, value, msa_name, state_abbrev from gdp left join spine1 using (cbsa_code)", "gdp", "spine1"),
    "zip_prefix_metro": with_ctes(f"select o_orderkey, {_ZIP} as zip, left({_ZIP}, 3) as zip_prefix, n_name as metro from xwalk left join nation on lpad(cast(n_nationkey as varchar), 3, '0') = left({_ZIP}, 3)", "xwalk"),
    "gdp_metrics": with_ctes(
        """select cbsa_code, date, f as population_flag, unnest(['real_gdp_per_capita', 'real_gdp_per_100k', 'real_gdp_per_100k_yoy_pct']) as metric_name, round(unnest([c, k, g]), 3) as value, unnest(['dollars_per_person', 'dollars_per_100k', 'pct']) as units from gdpm where f <> 'missing'
           union all select cbsa_code, date, f, unnest(['real_gdp_per_capita', 'real_gdp_per_100k']), null, unnest(['dollars_per_person', 'dollars_per_100k']) from gdpm where f = 'missing'""",
        "gdpm",
    ),
    "invalid_population": with_ctes("select * from population where value <= 0", "population"),
    "unemployment_metrics": with_ctes(
        "select cbsa_code, date, 'unemployment_rate_quarterly' as metric_name, round(v, 6) as value, 'pct' as units from unemp union all select cbsa_code, date, 'unemployment_change_pp', round(pp, 6), 'pp' from unemp where pp is not null", "unemp"
    ),
    "stress_board": with_ctes("select * replace (round(real_gdp_yoy_pct, 4) as real_gdp_yoy_pct, round(real_gdp_per_100k, 4) as real_gdp_per_100k, round(unemployment_rate, 4) as unemployment_rate, round(unemployment_yoy_pp, 4) as unemployment_yoy_pp) from board", "board"),
    "top_metros": with_ctes("select cbsa_code, real_gdp_level from board order by real_gdp_level desc nulls last, cbsa_code limit 10", "board"),
    "policy_quarter_agg": with_ctes(
        f"""select SeriesID, family, case family when 'gdp' then 'sum' when 'unemployment' then 'mean' when 'population' then 'point_in_time' else 'last' end as aggregation_rule, DATE,
            round(case family when 'gdp' then s when 'unemployment' then a else l end, 3) as VALUE from (select SeriesID, {_FAM} as family, {_QE} as DATE, sum(VALUE) as s, avg(VALUE) as a, max_by(VALUE, DATE) as l from series group by SeriesID, {_QE})""",
        "series",
    ),
}
