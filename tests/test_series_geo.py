"""Series, indicators, geography and local macro against plain-Python answers."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from plan_nodes import ran
from quarterdeck.operators import geo, indicators, series


def long_frame(spark, rows):
    return spark.createDataFrame(rows, "SeriesID string, DATE date, VALUE double")


def months(n, start=2015):
    return [dt.date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


@pytest.fixture(scope="module")
def walk():
    rng = random.Random(3)
    out, level = [], 100.0
    for _ in range(300):
        level += rng.uniform(-3, 3)
        out.append(round(level, 3))
    return out


def by_date(df, column, sid="A"):
    return [r[0] for r in df.filter(F.col("SeriesID") == sid).orderBy("DATE").select(column).collect()]


@pytest.mark.parametrize("span", [1, 2, 12, 50])
def test_ema_against_recursion(spark, walk, span):
    df = long_frame(spark, [("A", d, v) for d, v in zip(months(300, 1995), walk)] + [("B", dt.date(2020, 1, 1), 5.0), ("B", dt.date(2020, 2, 1), None)])
    alpha, level, want = 2 / (span + 1), None, []
    for v in walk:
        level = v if level is None else alpha * v + (1 - alpha) * level
        want.append(level)
    made = indicators.ema(df, span)
    assert by_date(made, "EMA") == pytest.approx(want)
    assert by_date(made, "EMA", "B") == [5.0, None]


def test_rsi_and_bands(spark, walk):
    vals = walk[:40]
    df = long_frame(spark, [("A", d, v) for d, v in zip(months(40), vals)] + [("U", d, float(i)) for i, d in enumerate(months(20))] + [("F", d, 1.0) for d in months(20)])
    got = indicators.rsi(indicators.bollinger(df, 5), 14)
    moves = [0.0] + [b - a for a, b in zip(vals, vals[1:])]
    for i, have in enumerate(by_date(got, "RSI")):
        if i < 13:
            assert have is None
            continue
        w = moves[i - 13 : i + 1]
        gain, loss = sum(m for m in w if m > 0), -sum(m for m in w if m < 0)
        assert have == pytest.approx(100 - 100 / (1 + gain / loss))
    assert by_date(got, "RSI", "U")[-1] == 100.0 and by_date(got, "RSI", "F")[-1] is None
    upper = by_date(got, "BB_Upper")
    assert upper[0] is None
    w = vals[10:15]
    mean = sum(w) / 5
    assert upper[14] == pytest.approx(mean + 2 * math.sqrt(sum((x - mean) ** 2 for x in w) / 4))


def test_daily_and_month_fill(spark):
    d = dt.date
    df = long_frame(spark, [("A", d(2024, 1, 30), 1.0), ("A", d(2024, 2, 2), None), ("A", d(2024, 4, 1), 4.0), ("B", d(2024, 2, 1), 9.0)])
    daily = series.daily_ffill(df)
    assert daily.filter("SeriesID = 'A'").count() == 63 and daily.filter("SeriesID = 'B'").count() == 61
    assert daily.filter("SeriesID = 'A' and DATE = date'2024-03-31'").first()["VALUE"] == 1.0
    asof = {(r["DATE"], r["VALUE"]) for r in series.month_asof(df).filter("SeriesID = 'A'").collect()}
    assert asof == {(d(2024, 1, 1), None), (d(2024, 2, 1), 1.0), (d(2024, 3, 1), 1.0), (d(2024, 4, 1), 4.0)}
    linear = {r["DATE"]: r["VALUE"] for r in series.month_linear(df).filter("SeriesID = 'A'").collect()}
    assert linear[d(2024, 3, 1)] == pytest.approx(1.0 + 3.0 * 31 / 62)


def test_frequencies(spark):
    d = dt.date
    rows = [("day", d(2024, 1, 1) + dt.timedelta(i), 1.0) for i in range(30)]
    rows += [("month", x, 1.0) for x in months(24)] + [("quarter", x, 1.0) for x in months(36)[::3]] + [("two", x, 1.0) for x in months(2)]
    work = [d(2024, 1, 1) + dt.timedelta(i) for i in range(60)]
    rows += [("work", x, 1.0) for x in work if x.weekday() < 5]
    got = {r["SeriesID"]: r["frequency"] for r in series.infer_frequency(long_frame(spark, rows)).collect()}
    assert got == {"day": "daily", "month": "monthly", "quarter": "quarterly", "two": "monthly", "work": "daily"}


def test_lag_keeps_fourth_quarters(spark):
    d = dt.date
    df = long_frame(spark, [("A", d(2023, 9, 30), 1.0), ("A", d(2023, 12, 31), 2.0)])
    assert by_date(series.lagged_quarters(df), "DATE") == [d(2023, 12, 31), d(2024, 3, 31)]


def test_lagged_correlation_needs_four_pairs(spark):
    ends = [dt.date(2020 + i // 4, (i % 4 + 1) * 3, [31, 30, 30, 31][i % 4]) for i in range(8)]
    subject = spark.createDataFrame([(e, float(i)) for i, e in enumerate(ends)], "REPDTE date, m double")
    macro = long_frame(spark, [("up", e, float(i)) for i, e in enumerate(ends)] + [("short", e, float(i)) for i, e in enumerate(ends[:3])])
    got = {r["SeriesID"]: (r["pairs"], r["correlation"]) for r in series.lagged_correlation(subject, ["m"], macro, "REPDTE").collect()}
    assert got["up"][0] == 7 and got["up"][1] == pytest.approx(1.0)
    assert got["short"] == (3, None)


def test_signals_and_scores(spark, walk):
    df = long_frame(spark, [("A", d, v) for d, v in zip(months(60), walk)])
    tech = indicators.technical_indicators(df).withColumn("best_technical", F.lit("SMA"))
    words = by_date(indicators.select_signals(tech), "signal")
    assert words[0] == "Awaiting Data (Insufficient History)" and all(words)
    meta = spark.createDataFrame([("A", "lagging", "x", {"stress": 1.0}, "inversion")], "SeriesID string, type string, long_name string, benchmark map<string,double>, floor_rule string")
    scored = indicators.risk_score(df, meta)
    scores = by_date(scored, "risk_score")
    assert scores[10] is None and all(30 <= s <= 100 for s in scores[11:])
    fields = indicators.analysis_fields(indicators.long_horizon(df).join(meta.select("SeriesID", "benchmark"), "SeriesID"), "benchmark")
    assert by_date(fields, "benchmark_context")[-1] == "Value exceeds stress threshold of 1.00"


def test_policies(spark):
    rows = [("g", "gdp", 1.0), ("g", "gdp", 3.0), ("u", "unemployment", 1.0), ("u", "unemployment", 3.0), ("p", "population", 1.0), ("p", "population", 3.0)]
    df = spark.createDataFrame([(s, f, dt.date(2024, 1 + i % 2, 1), v) for i, (s, f, v) in enumerate(rows)], "SeriesID string, family string, DATE date, VALUE double")
    assert {r["SeriesID"]: r["VALUE"] for r in series.quarterly_by_policy(df).collect()} == {"g": 4.0, "u": 2.0, "p": 3.0}


def metro(spark, values):
    return spark.createDataFrame([("10001", dt.date(2019 + i, 1, 1), v) for i, v in enumerate(values)], "cbsa_code string, date date, value double")


def test_constant_population_keeps_growth(spark):
    gdp = metro(spark, [100.0, 110.0, 121.0, 133.1, 146.41])
    out = geo.gdp_metrics(gdp, metro(spark, [1000.0])).filter("metric_name = 'real_gdp_per_100k_yoy_pct' and value is not null")
    assert [r["value"] for r in out.orderBy("date").collect()] == pytest.approx([10.0] * 4)


def test_bad_population(spark):
    gdp = metro(spark, [100.0, 110.0])
    bad = geo.gdp_metrics(gdp, metro(spark, [0.0])).collect()
    assert {r["population_flag"] for r in bad} == {"invalid"} and all(r["value"] is None for r in bad)
    none = geo.gdp_metrics(gdp, metro(spark, [])).collect()
    assert {r["population_flag"] for r in none} == {"missing"}
    assert geo.invalid_population(metro(spark, [0.0, 5.0])).count() == 1


def test_spine_tiers(spark):
    req = spark.createDataFrame([("cbsa", "10001"), ("cbsa", "zz"), ("zip", "501"), ("zip", "99999"), ("county_fips", "1001"), ("state", "ny")], "geo_type string, geo_value string")
    metros = spark.createDataFrame([("10001", "Metro", "36", "NY")], "cbsa_code string, msa_name string, state_fips string, state_abbrev string")
    zips = geo.best_metro_per_zip(spark.createDataFrame([("00501", "10001", 0.7), ("00501", "20002", 0.3), ("00501", "", 0.9)], "zip string, cbsa_code string, tot_ratio double"))
    counties = spark.createDataFrame([("01001", "10001")], "county_fips string, cbsa_code string")
    states = spark.createDataFrame([("NY", "36")], "state_abbrev string, state_fips string")
    rows = {(r["source_geo_type"], r["source_geo_value"]): r for r in geo.build_spine(req, metros, zips, counties, states).collect()}
    methods = {k: (r["mapping_method"], r["mapping_weight"], r["quality_flag"]) for k, r in rows.items()}
    assert methods == {
        ("cbsa", "10001"): ("direct_cbsa", 1.0, "high"),
        ("cbsa", "000zz"): ("unmatched", 0.0, "unmatched"),
        ("zip", "00501"): ("zip_to_cbsa", 0.7, "medium"),
        ("zip", "99999"): ("unmatched", 0.0, "unmatched"),
        ("county_fips", "01001"): ("county_to_cbsa", 1.0, "low"),
        ("state", "NY"): ("state_fallback", 1.0, "low"),
    }
    assert rows[("county_fips", "01001")]["state_fips"] == "01"


def test_spine_is_one_join_of_each_request(spark, folder):
    """Requests meet one lookup on their own kind and value: no key is empty, and one exchange serves the distinct and the join."""
    rows = [("cbsa", "10001"), ("cbsa", "99999"), ("cbsa", "x"), ("zip", " 7"), ("zip", "8"), ("zip", None), ("county_fips", "3"), ("county_fips", "4"), ("state", "ny"), ("state", "zz"), ("other", "1"), (None, "5"), ("zip", "7")]
    spark.createDataFrame(rows, "geo_type string, geo_value string").write.parquet(f"{folder}/r")
    metros = spark.createDataFrame([("10001", "One", "36", "NY"), ("10002", "Two", "34", "NJ")], "cbsa_code string, msa_name string, state_fips string, state_abbrev string")
    zips = spark.createDataFrame([("00007", "10002", 0.5), ("10001", "10001", None)], "zip string, cbsa_code string, tot_ratio double")
    counties = spark.createDataFrame([("00003", "10001"), ("00004", None)], "county_fips string, cbsa_code string")
    states = spark.createDataFrame([("NY", "36")], "state_abbrev string, state_fips string")
    spine = geo.build_spine(spark.read.parquet(f"{folder}/r"), metros, zips, counties, states)
    got = {(r[0], r[1]): tuple(r[2:]) for r in spine.collect()}
    none = (None, None, None, None, "unmatched", 0.0, 0.0, "unmatched")
    assert got == {
        ("cbsa", "10001"): ("10001", "One", "36", "NY", "direct_cbsa", 1.0, 100.0, "high"),
        ("cbsa", "99999"): ("99999", None, None, None, "direct_cbsa", 1.0, 100.0, "high"),
        ("cbsa", "0000x"): none,
        ("zip", "00007"): ("10002", "Two", "34", "NJ", "zip_to_cbsa", 0.5, 50.0, "medium"),
        ("zip", "00008"): none,
        ("zip", None): none,
        ("county_fips", "00003"): ("10001", "One", "00", "NY", "county_to_cbsa", 1.0, 100.0, "low"),
        ("county_fips", "00004"): none,
        ("state", "NY"): (None, None, "36", "NY", "state_fallback", 1.0, 100.0, "low"),
        ("state", "ZZ"): (None, None, None, "ZZ", "state_fallback", 1.0, 100.0, "low"),
        ("other", "00001"): none,
        (None, "00005"): none,
    }
    nodes = ran(spine)
    scans = [t for n, t in nodes if n.startswith("Scan parquet")]
    assert len(scans) == 1
    joins = [t for n, t in nodes if "Join" in n and "geo_type" in t]
    assert len(joins) == 1 and "geo_value" in joins[0]


def test_attributes_are_joined_before_indicators_become_rows(spark):
    """The join's shuffle carries a row of a series and day, not one for each indicator."""
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), 2.0, 3.0), (2, dt.date(2020, 1, 1), None, 4.0)], "SeriesID long, DATE date, VALUE double, SMA double")
    attributes = spark.createDataFrame([(1, "leading", 7)], "SeriesID long, Type string, Rank long")
    out = series.indicator_long(df, ["SMA"], attributes, "Actual")
    assert out.columns == ["SeriesID", "DATE", "Indicator_Name", "Indicator_Value", "Type", "Rank"]
    day = dt.date(2020, 1, 1)
    assert {tuple(r) for r in out.collect()} == {(1, day, "SMA", 3.0, "leading", 7), (1, day, "Actual", 2.0, "leading", 7), (2, day, "SMA", 4.0, None, None), (2, day, "Actual", None, None, None)}
    names = [name for name, _ in ran(out)]  # from the result down
    assert names.index("Expand") < next(k for k, n in enumerate(names) if "Join" in n)
