"""Second moments against numpy: gaps, wide tables, columns that do not vary or depend on each other."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import forecast, moments


def frame(spark, x, names):
    rows = [tuple(None if math.isnan(v) else float(v) for v in row) for row in x]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)


def test_correlations_with_gaps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1.0, (400, 6))
    x[:, 1] = x[:, 0] * 0.5 + rng.normal(0, 0.3, 400)
    x[:, 4] = 7.0
    x[rng.random((400, 6)) < 0.2] = np.nan
    x[:, 5] = np.nan
    x[:1, 5] = 3.0
    names = ["a", "b c", "d", "e.f", "flat", "one"]
    got = {(r["a"], r["b"]): r["correlation"] for r in forecast.correlations(frame(spark, x, names), names).collect()}
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if not both.any():
                assert (a, names[j]) not in got
            elif "flat" in (a, names[j]) or both.sum() < 2:
                assert got[a, names[j]] is None
            else:
                assert got[a, names[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_three_hundred_columns(spark):
    k = 300
    df = spark.range(3000).select(*[F.sin(F.col("id") * (i + 1) * 0.37 + i).alias(f"c{i}") for i in range(k)])
    names = [f"c{i}" for i in range(k)]
    got = forecast.correlations(df, names)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    rows = {(r["a"], r["b"]): r["correlation"] for r in got.collect()}
    x = np.array(df.limit(3000).toPandas())
    want = np.corrcoef(x.T)
    assert len(rows) == k * (k - 1) // 2
    assert max(abs(rows[f"c{i}", f"c{j}"] - want[i, j]) for i in range(0, k, 7) for j in range(i + 1, k, 11)) < 1e-9


def test_least_squares(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 5)) * [1, 1e4, 1e-4, 3, 1]
    x[:, 4] = 2 * x[:, 0]  # depends on another
    y = x[:, :4] @ [2.0, -3e-4, 5e3, 0.5] + rng.normal(0, 0.01, 300)
    data = np.column_stack([x, y])
    data[0, 1] = np.nan  # a row with a gap does not count
    names = ["a", "b", "c", "d", "e", "y"]
    df = frame(spark, data, names)
    found = moments.least_squares(df, names[:4], "y")
    want = np.linalg.lstsq(x[1:, :4], y[1:], rcond=None)[0]
    assert [found[c] for c in names[:4]] == pytest.approx(want, rel=1e-8)
    twice = moments.least_squares(df, ["a", "e"], "y")
    assert twice["a"] + 2 * twice["e"] == pytest.approx(moments.least_squares(df, ["a"], "y")["a"])
    assert moments.least_squares(df.filter("false"), ["a", "b"], "y") == {"a": 0.0, "b": 0.0}
    row = moments.errors(df.withColumn("prediction", moments.linear(found)).dropna(), "y").first()
    gap = y[1:] - x[1:, :4] @ want
    assert [row["rmse"], row["mse"], row["mae"]] == pytest.approx([np.sqrt((gap**2).mean()), (gap**2).mean(), np.abs(gap).mean()], rel=1e-6)


def test_linear_scores_agree_with_the_library_model(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(3, 1, (500, 3))
    y = x @ [1.0, 2.0, -1.0] + rng.normal(0, 0.5, 500)
    df = frame(spark, np.column_stack([np.arange(500), x, y]), ["id", "a", "b", "c", "y"])
    got = {r["model"]: r for r in forecast.linear_scores(df, ["a", "b", "c"], "y", ["id"]).collect()}
    train, test = forecast.hash_split(df, ["id"])
    assert 300 < train.count() < 400 and train.count() + test.count() == 500
    for name, scaled in (("linear", False), ("linear_scaled", True)):
        fitted = forecast.linear_model(["a", "b", "c"], "y", scaled).fit(train)
        want = forecast.evaluate(spark, fitted.transform(test), "y", name).first()
        assert [got[name][m] for m in ("rmse", "mse", "mae")] == pytest.approx([want[m] for m in ("rmse", "mse", "mae")], rel=1e-6)
