"""Exponential mean and expanding percentile: plain answers, and plans in which nothing holds a whole series."""

import bisect
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import indicators

SCHEMA = "SeriesID string, DATE date, VALUE double"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def ranks_of(values):
    seen, out = [], []
    for v in values:
        bisect.insort(seen, v)
        out.append((bisect.bisect_left(seen, v), bisect.bisect_right(seen, v)))
    return out


def test_expanding_rank_with_ties(spark):
    rng = random.Random(11)
    sizes = {"a": 700, "one": 1, "b": 16, "c": 17, "flat": 40, "d": 257, "zero": 3}
    want, rows = {}, []
    for name, n in sizes.items():
        values = [5.0 if name == "flat" else [0.0, -0.0, 0.0][i] if name == "zero" else float(rng.randint(-20, 20)) if i % 2 else rng.uniform(-20, 20) for i in range(n)]
        want[name] = ranks_of(values)
        rows += [(name, i + 1, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "SeriesID string, _pos long, VALUE double").repartition(7)
    got = {}
    for r in indicators.expanding_rank(df).collect():
        got.setdefault(r["SeriesID"], {})[r["_pos"]] = (r["lt"], r["le"])
    assert {k: [v[i + 1] for i in range(len(v))] for k, v in got.items()} == want
    assert indicators.expanding_rank(df.filter("false")).count() == 0


def long_series(spark, n, name="A"):
    """One series of ``n`` days with values that come again."""
    return spark.range(n).select(F.lit(name).alias("SeriesID"), F.expr("date_add(date'0001-01-01', cast(id as int))").alias("DATE"), ((F.col("id") * 7919 % 10007) / 10.0 - 400).alias("VALUE"))


def test_expanding_rank_of_a_long_series(spark):
    n = 60_000
    df = long_series(spark, n).select("SeriesID", "VALUE", F.expr("datediff(DATE, date'0001-01-01') + 1").alias("_pos"))
    values = [r["VALUE"] for r in df.orderBy("_pos").collect()]
    got = {r["_pos"]: (r["lt"], r["le"]) for r in indicators.expanding_rank(df).collect()}
    assert [got[i + 1] for i in range(n)] == ranks_of(values)


def test_ema_of_a_long_series(spark):
    n, span = 300_000, 40
    values = [(i * 7919 % 10007) / 10.0 - 400 for i in range(n)]
    level, want = values[0], []
    for v in values:
        level = level + 2 / (span + 1) * (v - level)
        want.append(level)
    got = [r["EMA"] for r in indicators.ema(long_series(spark, n), span).orderBy("DATE").select("EMA").collect()]
    assert len(got) == n and max(abs(a - b) for a, b in zip(got, want)) < 1e-6


@pytest.mark.parametrize("span", [2, 3, 300])
def test_ema_of_values_far_apart(spark, span):
    values = [1e12] + [float(i % 3) for i in range(400)] + [-1e9] + [0.5] * 300
    df = spark.createDataFrame([("A", dt.date(2000, 1, 1) + dt.timedelta(i), v) for i, v in enumerate(values)], SCHEMA)
    level, want = values[0], []
    for v in values:
        level = 2 / (span + 1) * v + (1 - 2 / (span + 1)) * level
        want.append(level)
    got = [r["EMA"] for r in indicators.ema(df, span).orderBy("DATE").select("EMA").collect()]
    assert got == pytest.approx(want, rel=1e-9)


def test_scan_steps_follow_the_decay_alone(spark):
    """The depth of the scan is the same for a short and a long table, and nothing is gathered."""
    plans = [plan_of(indicators.ema(long_series(spark, n), 12)) for n in (10, 1_000_000)]
    assert plans[0].count("Window") == plans[1].count("Window") < 20
    assert not any(word in p for p in plans for word in ("collect_list", "concat(", "aggregate("))


def meta(spark, benchmark=None, rule=None):
    return spark.createDataFrame([("A", "lagging", "x", benchmark, rule)], "SeriesID string, type string, long_name string, benchmark map<string,double>, floor_rule string")


def test_no_row_of_the_risk_score_carries_its_history(spark):
    df = indicators.risk_score(long_series(spark, 100), meta(spark, None, "credit_spread"))
    assert "collect_list" not in plan_of(df)
    values = [r["VALUE"] for r in long_series(spark, 100).orderBy("DATE").collect()]
    for i, (r, (lt, le)) in enumerate(zip(df.orderBy("DATE").collect(), ranks_of(values))):
        extreme = (lt + le + 1) * 50 / (i + 1) > 90
        assert r["risk_score"] is None if i < 11 else (r["risk_score"] >= 70 if extreme else r["risk_score"] < 70)


@pytest.mark.parametrize(
    "benchmark,value,points",
    [
        ({"stress": 10.0}, 10.5, 30.0),
        ({"stress": 10.0}, 8.5, 20.0),
        ({"stress": 10.0}, 8.0, 0.0),
        ({"Extreme": -10.0}, -9.0, 30.0),
        ({"Extreme": -10.0}, -10.0, 0.0),  # four fifths of it are above it
        ({"normal": 4.0}, 6.5, 15.0),
        ({"normal": 4.0}, 1.5, 15.0),
        ({"normal": 4.0}, 6.0, 0.0),
        ({"normal": -4.0}, 400.0, 0.0),  # the distance is divided by the level itself
        ({"normal": 0.0}, 0.1, 15.0),
        ({"normal": 0.0}, 0.0, 0.0),
        ({"stress": 100.0, "normal": 1.0}, 90.0, 20.0),
        ({}, 5.0, 0.0),
        (None, 5.0, 0.0),
    ],
)
def test_points_for_levels_of_either_sign(spark, benchmark, value, points):
    df = spark.createDataFrame([(value, benchmark)], "VALUE double, benchmark map<string,double>")
    assert df.select(indicators.benchmark_points().alias("p")).first()["p"] == points
    assert math.isfinite(points)
