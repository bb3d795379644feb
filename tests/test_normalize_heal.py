"""Residuals, healing, gates, composites and exact quantiles."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import compare, composite, heal, normalize, quantile, ratios
from quarterdeck.operators.quantile import exact_quantile, exact_quantiles

from plan_nodes import ran

DAY = dt.date(2024, 3, 31)


@pytest.mark.parametrize(
    "total, excluded, tolerance, value, severity",
    [
        (1000.0, 500.0, 0.05, 500.0, "ok"),
        (1000.0, 1030.0, 0.05, 0.0, "minor_clip"),
        (1000.0, 1200.0, 0.05, None, "material_nan"),
        (1000.0, 1050.0, 0.05, 0.0, "minor_clip"),
        (1000.0, 1200.0, 0.25, 0.0, "minor_clip"),
        (0.0, 0.0, 0.05, 0.0, "ok"),
        (0.0, 10.0, 0.05, None, "material_nan"),
        (None, 10.0, 0.05, None, "ok"),
        (10.0, None, 0.05, None, "ok"),
    ],
)
def test_residual(spark, total, excluded, tolerance, value, severity):
    df = spark.createDataFrame([(total, excluded)], "t double, e double")
    r = df.select(normalize.normalized_residual("t", "e", tolerance).alias("r")).first()["r"]
    assert (r["value"], r["severity"]) == (value, severity)


def test_heal_every_case(spark):
    cases = [(5.0, 7.0, 5.0), (0.0, 7.0, 7.0), (None, 7.0, 7.0), (0.0, 0.0, 0.0), (None, 0.0, 0.0), (0.0, None, 0.0), (None, None, None)]
    main = spark.createDataFrame([(i, DAY, m) for i, (m, _, _) in enumerate(cases)], "CERT long, REPDTE date, x double")
    patch = spark.createDataFrame([(i, DAY, p, 1.0) for i, (_, p, _) in enumerate(cases)] + [(99, DAY, 1.0, 1.0)], "CERT long, REPDTE date, x double, extra double")
    out = {r["CERT"]: r for r in heal.heal(main, patch).collect()}
    assert [out[i]["x"] for i in range(len(cases))] == [w for _, _, w in cases]
    assert 99 not in out and out[0]["extra"] == 1.0


def test_gate_needs_more_than_half(spark):
    rows = [(1, DAY, 0.0), (2, DAY, 1.0), (1, dt.date(2024, 6, 30), None), (2, dt.date(2024, 6, 30), 0.0)]
    df = spark.createDataFrame(rows, "CERT long, REPDTE date, RCFD1545 double")
    assert [r["REPDTE"] for r in heal.quarters_to_patch(df).collect()] == [dt.date(2024, 6, 30)]


def test_composite_of_one_member_is_the_member(spark):
    df = spark.createDataFrame([(7, DAY, 3.0, 0.2, 10.0)], "CERT long, REPDTE date, LNLS double, A_Rate double, ASSET double")
    bridge = spark.createDataFrame([("G", 7, 4, False)], "group_key string, CERT long, display_order int, use_normalized boolean")
    for method in ("mean", "weighted"):
        row = composite.composites(df, bridge, ["LNLS", "A_Rate"], method=method).first()
        assert (row["CERT"], row["NAME"], row["LNLS"]) == (90004, "AVG: G", 3.0)
        assert row["A_Rate"] == pytest.approx(0.2)


def test_weighted_composite_and_zero_weights(spark):
    df = spark.createDataFrame([(1, DAY, 10.0, 0.1), (2, DAY, 30.0, 0.5), (3, DAY, 0.0, 0.3), (4, DAY, 0.0, 0.5)], "CERT long, REPDTE date, LNLS double, A_Rate double")
    bridge = spark.createDataFrame([("A", 1, 1, False), ("A", 2, 1, False), ("Z", 3, 2, False), ("Z", 4, 2, False)], "group_key string, CERT long, display_order int, use_normalized boolean")
    got = {r["group_key"]: r["A_Rate"] for r in composite.composites(df, bridge, ["LNLS", "A_Rate"], method="weighted").collect()}
    assert got["A"] == pytest.approx(0.4) and got["Z"] == pytest.approx(0.4)


@pytest.mark.parametrize("prob", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile_against_brute_force(spark, prob):
    rng = random.Random(5)
    rows = [("hot", float(rng.randint(0, 50000))) for _ in range(60000)] + [("small", 1.0), ("small", 2.0), ("one", 4.0)] + [(None, 7.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["median"], r["n"]) for r in exact_quantile(df, ["k"], "v", prob).collect()}
    for k in {r[0] for r in rows}:
        values = sorted(v for key, v in rows if key == k)
        pos = prob * (len(values) - 1)
        lo, hi = values[int(pos)], values[min(int(pos) + 1, len(values) - 1)]
        assert got[k][0] == pytest.approx(lo + (hi - lo) * (pos - int(pos)))
        assert got[k][1] == len(values)
    if prob == 0.5:
        assert got["hot"][0] == statistics.median(v for k, v in rows if k == "hot")


@pytest.mark.parametrize("bracket", [(0.9, 0.95), (0.05, 0.1), (0.6, 0.4)])
def test_a_bracket_that_misses_is_widened(spark, monkeypatch, bracket):
    """The rank is found by exact counts, wherever the sketch points."""
    monkeypatch.setattr(quantile, "bracket", lambda prob, accuracy: bracket)
    rng = random.Random(6)
    values = {"a": [rng.gauss(0, 9) for _ in range(3001)], "b": [float(rng.randint(0, 3)) for _ in range(500)], "c": [2.0], "d": [1.0, 5.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double")
    for prob in (0.5, 0.1):
        for r in exact_quantile(df, ["k"], "v", prob).collect():
            vs = sorted(values[r["k"]])
            pos = prob * (len(vs) - 1)
            lo, hi = vs[int(pos)], vs[min(int(pos) + 1, len(vs) - 1)]
            assert (r["median"], r["n"]) == (pytest.approx(lo + (hi - lo) * (pos - int(pos))), len(vs))


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("i", -inf), ("i", 1.0), ("i", inf), ("n", 1.0), ("n", nan), ("n", 3.0), ("w", -1e308), ("w", 1e308), ("w", 5.0), ("none", None), ("t", 7.0), ("t", 7.0), ("t", 7.0), ("t", 9.0)]
    df = spark.createDataFrame(rows, "metric string, v double")
    got = {r["metric"]: r["median"] for r in exact_quantile(df, ["metric"], "v").collect()}
    assert got == {"i": 1.0, "n": 3.0, "w": 5.0, "t": 7.0}
    assert [tuple(r) for r in exact_quantiles(df.filter("metric = 't'"), [], ["v", "v"]).collect()] == [("v", 7.0, 4)] * 2
    assert exact_quantile(df.filter("false"), ["metric"], "v").count() == 0 and exact_quantiles(df.filter("false"), [], ["v"]).count() == 0


def test_quantile_lists_few_values_and_orders_them_in_many_ranges(spark):
    """Of 200 000 values of one group some hundreds are listed, and no window holds them all."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    got = exact_quantile(df, [], "v", 0.5)
    values = sorted(i * 7919 % 200_003 for i in range(200_000))
    assert got.first()["median"] == (values[99_999] + values[100_000]) / 2
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("_cell" in line for line in windows)


def wide_panel(spark, n=60):
    rng = random.Random(8)
    columns = {m: [rng.choice([None, float(rng.randint(0, 9)), rng.uniform(-5, 5)]) for _ in range(n)] for m in compare.SUMMARY_METRICS}
    columns |= {s: [rng.choice([None, rng.uniform(0, 1)]) for _ in range(n)] for s in compare.NORMALIZED_METRICS.values()}
    rows = [(i, DAY, *[columns[c][i] for c in columns]) for i in range(n)] + [(1, dt.date(2020, 3, 31), *[99.0] * len(columns))]
    panel = spark.createDataFrame(rows, "CERT long, REPDTE date, " + ", ".join(f"{c} double" for c in columns))
    bridge = spark.createDataFrame([(g, i, g == "N") for g in ("A", "N") for i in range(n) if g == "A" or i % 3 == 0], "group_key string, CERT long, use_normalized boolean")
    return columns, panel, bridge


def test_comparison_of_all_metrics(spark):
    columns, panel, bridge = wide_panel(spark)
    got = {(r["metric"], r["group_key"]): r for r in compare.peer_comparison(panel, bridge, 3).collect()}
    ranges = {(r["metric"], r["group_key"]): r for r in compare.peer_range(panel, bridge, compare.SUMMARY_METRICS).collect()}
    assert len(compare.SUMMARY_METRICS) == 23 and {m for m, _ in got} == set(compare.SUMMARY_METRICS)
    for metric in compare.SUMMARY_METRICS:
        for group in ("A", "N"):
            members = [i for i in range(60) if group == "A" or i % 3 == 0]
            source = columns[compare.NORMALIZED_METRICS.get(metric, metric) if group == "N" else metric]
            vs, s, r = [source[i] for i in members if source[i] is not None], source[3], got[metric, group]
            assert (r["peer_count"], r["min"], r["max"], r["subject_value"]) == (len(vs), min(vs), max(vs), s)
            assert r["mean"] == pytest.approx(statistics.fmean(vs)) and r["median"] == pytest.approx(statistics.median(vs))
            lt, le = sum(v < s for v in vs) if s is not None else 0, sum(v <= s for v in vs) if s is not None else 0
            assert r["pct"] == (None if s is None else pytest.approx((lt + le + (le > lt)) * 50 / len(vs)))
            plain = [(columns[metric][i], i) for i in members if columns[metric][i] is not None]
            q = ranges[metric, group]
            assert (q["lo"], q["lo_holder"], q["hi"], q["members"]) == (*min(plain), max(plain)[0], len(plain))
            assert q["hi_holder"] == min(i for v, i in plain if v == q["hi"])


def test_comparison_reads_its_panel_a_fixed_number_of_times(spark, folder):
    """One exchange has all statistics of all metrics; scans and exchanges do not grow with the number of metrics."""
    _, panel, bridge = wide_panel(spark)
    panel.write.parquet(f"{folder}/p")
    bridge.write.parquet(f"{folder}/b")
    plans = []
    for metrics in (compare.SUMMARY_METRICS[:2], compare.SUMMARY_METRICS):
        df = compare.peer_comparison(spark.read.parquet(f"{folder}/p"), spark.read.parquet(f"{folder}/b"), 3, metrics)
        df.collect()
        plans.append(ran(df))
    # the panel for the aggregate, the counts and the values in the brackets; nothing grows with the number of metrics
    scans = [[t for n, t in p if n.startswith("Scan parquet") and "CERT" in t and "REPDTE" in t] for p in plans]
    assert len(scans[0]) == len(scans[1]) <= 3
    assert len({sum(n == "Exchange" for n, _ in p) for p in plans}) == 1
    stats = [t for _, t in plans[1] if "Aggregate(" in t and "avg(" in t]
    assert len(stats) == 2 and all(t.count("percentile_approx(") == 23 and t.count("avg(") == 23 for t in stats)  # partial and final


def test_percentile_of_score(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (3.0,), (4.0,)], "v double").withColumn("s", F.lit(3.0))
    assert df.agg(compare.percentile_rank("v", "s").alias("p")).first()["p"] == 70.0


def test_nearest_period_prefers_the_earlier_on_a_tie(spark):
    days = [dt.date(2023, 3, 30), dt.date(2023, 4, 1), dt.date(2024, 3, 31)]
    df = spark.createDataFrame([(d,) for d in days], "REPDTE date")
    assert df.select(compare.nearest_period(df, 1).alias("p")).first()["p"] == dt.date(2023, 3, 30)


def test_npl_and_equity_mix(spark):
    rows = [(200.0, 3.0, 1.0, 2.0, 8.0, 50.0, 10.0, 20.0, 5.0, 9.0, 6.0), (0.0, None, 0.0, 2.0, 0.0, 0.0, 1.0, None, None, None, 6.0)]
    names = ["LNLS", "P3LNLS", "P9LNLS", "NCLNLS", "Total_ACL", "EQ", "EQCS", "EQUP", "EQCCOMPI", "RB2LNRES", "LNATRES"]
    out = ratios.npl_and_equity_mix(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)))
    wanted = ["AOBS", "Net_Retained_Earnings", "Total_Past_Due_to_Book", "NPL_to_Gross_Loans_Rate", "NPL_to_Past_Due", "NPL_to_ACL", "Common_Stock_Pct", "EQSUR_Pct", "Retained_Earnings_Pct"]
    assert [tuple(r) for r in out.select(wanted).collect()] == [
        (3.0, 15.0, 0.02, 0.01, 0.5, 0.25, 20.0, 0.0, 30.0),
        (-6.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_status_is_counted_while_the_healed_rows_are_written(spark):
    """One run of the heal join: what comes back reads the written rows only."""
    df = spark.createDataFrame([(1, DAY, None), (2, DAY, 3.0), (3, DAY, None)], "CERT long, REPDTE date, RCONJ466 double").withColumn("RCFDJ466", F.lit(None).cast("double"))
    patch = spark.createDataFrame([(1, DAY, 9.0)], "CERT long, REPDTE date, RCONJ466 double")
    done = heal.heal_with_status(df, patch)
    assert "Join" not in done._jdf.queryExecution().optimizedPlan().toString()
    want = {1: (9.0, 1, "SUCCESS"), 2: (3.0, 1, "SUCCESS"), 3: (None, 0, "MISSING_DATA")}
    assert {r["CERT"]: (r["RCONJ466"], r["RIC_SOURCE_AVAILABLE"], r["RIC_Source_Status"]) for r in done.collect()} == want
    lazy = heal.heal_status(heal.heal(df, patch))
    assert {r["CERT"]: (r["RCONJ466"], r["RIC_SOURCE_AVAILABLE"], r["RIC_Source_Status"]) for r in lazy.collect()} == want
    for rows in (df.filter("false"), df.withColumn("RCONJ466", F.lit(None).cast("double"))):
        assert {r["RIC_Source_Status"] for r in heal.heal_with_status(rows, patch.filter("false")).collect()} == ({"NO_FIELDS"} if rows.count() else set())
    assert [r["RIC_Source_Status"] for r in heal.heal_with_status(df.drop("RCONJ466", "RCFDJ466"), patch.drop("RCONJ466")).collect()] == ["NO_FIELDS"] * 3
