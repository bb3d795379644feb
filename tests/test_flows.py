"""Known answers of the entity-ordered operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plan_nodes import ran
from quarterdeck.catalog import normalization
from quarterdeck.operators import flows
from quarterdeck.plans import shapes


def quarter(text):
    year, q = int(text[:4]), int(text[5])
    month = q * 3
    return dt.date(year, month, {3: 31, 6: 30, 9: 30, 12: 31}[month])


def panel(spark, rows, names="x"):
    data = [(c, quarter(p), *values) for c, p, *values in rows]
    fields = ", ".join(f"{n} double" for n in names.split())
    return spark.createDataFrame(data, f"CERT long, REPDTE date, {fields}")


def column(df, c, entity=1):
    return [r[0] for r in df.filter(F.col("CERT") == entity).orderBy("REPDTE").select(c).collect()]


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, "2023Q1", 100.0), (1, "2023Q2", 250.0), (1, "2023Q3", 420.0), (1, "2023Q4", 600.0)], [100, 150, 170, 180]),
        ([(1, "2023Q4", 500.0), (1, "2024Q1", 120.0), (1, "2024Q2", 300.0)], [500, 120, 180]),
        ([(1, "2023Q3", 420.0), (1, "2023Q4", 600.0)], [420, 180]),
        ([(1, "2023Q1", 100.0), (1, "2023Q2", None), (1, "2023Q3", 420.0)], [100, 0, 420]),
        # a missing quarter gives the flow of both
        ([(1, "2023Q1", 100.0), (1, "2023Q3", 420.0)], [100, 320]),
    ],
)
def test_discrete_flow(spark, rows, want):
    assert column(flows.ytd_to_discrete(panel(spark, rows), {"x": "q"}), "q") == want


def test_entities_do_not_mix(spark):
    rows = [(1, "2023Q1", 100.0), (1, "2023Q2", 250.0), (2, "2023Q1", 50.0), (2, "2023Q2", 80.0), (2, "2023Q3", 110.0), (2, "2023Q4", 200.0)]
    df = flows.ytd_to_discrete(panel(spark, rows), {"x": "q"})
    assert column(df, "q", 1) == [100, 150]
    assert column(df, "q", 2) == [50, 30, 30, 90]


def test_absent_column_and_options(spark):
    rows = [(1, "2023Q2", 250.0), (1, "2023Q4", 600.0)]
    df = panel(spark, rows)
    assert column(flows.ytd_to_discrete(df, {"gone": "q"}), "q") == [0, 0]
    assert column(flows.ytd_to_discrete(df, {"x": "q"}, fallback=False), "q") == [None, 350]
    assert column(flows.ytd_to_discrete(df, {"x": "q"}, strict=True), "q") == [None, None]


def test_flows_of_a_year_sum_to_its_total(spark, sf):
    from quarterdeck.plans.shapes import bank_panel

    raw = bank_panel(spark, sf, ["NTLNLS"]).filter("NTLNLS is not null")
    df = flows.ytd_to_discrete(raw, {"NTLNLS": "q"})
    per_year = df.groupBy("CERT", F.year("REPDTE")).agg(F.sum("q").alias("s"), F.max_by("NTLNLS", "REPDTE").alias("t"))
    assert per_year.filter(F.abs(F.col("s") - F.col("t")) > 1e-6).count() == 0


def test_annualize(spark):
    df = panel(spark, [(1, "2023Q1", 100.0), (1, "2023Q2", 100.0), (1, "2023Q3", 300.0), (1, "2023Q4", 600.0)])
    assert column(df.withColumn("a", flows.annualize_ytd(df, "x")), "a") == [400, 200, 400, 600]
    assert column(df.withColumn("a", flows.annualize_ytd(df, "gone")), "a") == [None] * 4


def test_growth_from_zero(spark):
    values = [0.0, 0.0, -50.0, 10.0, 5.0, 0.0, 25.0, None]
    rows = [(1, f"202{2 + i // 4}Q{i % 4 + 1}", v) for i, v in enumerate(values)]
    got = column(panel(spark, rows).withColumn("g", flows.growth("x")), "g")
    assert got == [None, None, None, None, None, 0.0, 1.5, None]


def test_profile_and_peak_stress(spark):
    rows = [(1, f"20{20 + i // 4}Q{i % 4 + 1}", float(i), 10.0) for i in range(10)] + [(2, "2020Q1", 3.0, 0.0)]
    out = flows.trailing_profile(panel(spark, rows, "na bal"), ["na", "bal"], {"stress": ("na", "bal")}, {"ever": "na"})
    got = {r["CERT"]: r.asDict() for r in out.collect()}
    assert got[1] == {"CERT": 1, "na": 5.5, "bal": 10.0, "stress": 0.9, "ever": 1.0}
    assert got[2]["stress"] == 0.0
    assert [r["CERT"] for r in flows.trailing_profile(panel(spark, rows, "na bal"), ["na"], min_periods=8).collect()] == [1]


def test_duplicate_periods_are_found(spark):
    df = panel(spark, [(1, "2020Q1", 1.0), (1, "2020Q1", 2.0), (2, "2020Q1", 1.0)])
    assert [r["CERT"] for r in flows.assert_unique_periods(df).collect()] == [1]


def test_lines_are_dealt_by_group_before_the_wide_aggregate(spark, sf, monkeypatch):
    """Of a large table no task may hold sums of more groups than its share of rows, and the rows are the same."""
    panel = lambda: shapes.bank_panel(spark, sf, ["LNLS", "NTLNLS", "P3CI"])
    plain = sorted(map(tuple, panel().collect()))
    days = sorted(map(tuple, shapes.daily_series(spark, sf).collect()))
    monkeypatch.setattr(shapes, "ROWS_A_TASK", 300)
    for df, want in ((panel(), plain), (shapes.daily_series(spark, sf), days)):
        assert sorted(map(tuple, df.collect())) == want
        names = [name for name, _ in ran(df)]  # from the result down to the scan
        exchanges, aggregates = ([k for k, n in enumerate(names) if n.startswith(kind)] for kind in ("Exchange", "HashAggregate"))
        assert aggregates and max(exchanges) > max(aggregates)
        assert df.rdd.getNumPartitions() >= 20


def test_a_large_table_is_dealt_whatever_the_number_of_cores(spark, sf, monkeypatch):
    """More cores than tasks' rows do not send the lines undealt into the aggregate, and a kept plan follows its tables' size."""
    lines = shapes.table(spark, sf, "lineitem")
    before = normalization.derived(spark, sf)
    assert normalization.derived(spark, sf) is before and shapes.tasks(lines) is None
    rows, cores = lines.count(), spark.sparkContext.defaultParallelism
    monkeypatch.setattr(shapes, "ROWS_A_TASK", -(-rows // (shapes.DIRECT + 1)))
    assert shapes.tasks(lines) == max(shapes.DIRECT + 1, cores)
    assert normalization.derived(spark, sf) is not before
    monkeypatch.setattr(shapes, "ROWS_A_TASK", -(-rows // (20 * cores)))
    assert shapes.tasks(lines) >= 19 * cores
