"""The registered queries: names, SQL, and a sample of them against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import SF
from quarterdeck import catalog
from tools.check_oracle import TABLES, rows_of

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()  # without those of the optional subpackage
WITHOUT_SQL = {"regression_scores"}
SAMPLE = [
    "ytd_to_discrete", "avg_8p_peak_stress", "heal_gated", "exclusions_gated", "reconciliation", "composite_weighted", "blank_low_coverage",
    "kri_ranges", "semi_join_tags_salted", "view_matrices", "flag_overlap", "concentration_above_lowest", "tracker_dedup",
    "infer_frequency", "lagged_corr", "stress_board", "preflight_verdict", "duplicate_groups", "dictionary_waterfall",
    "merge_schedules", "nested_json", "event_text_documents",
]


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "performance_flag" in df.columns


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    res = duck.execute(SQL[name])
    assert got == rows_of([d[0] for d in res.description], res.fetchall())


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_models_give_rows(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows and all(v is not None for r in rows for v in r)
