"""Key cleaning, tags, flags, ladder, matrices and the tracker."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plan_nodes import ran
from quarterdeck.functions import keys, missing
from quarterdeck.functions.names import find_column, find_role, normalize_names
from quarterdeck.operators import matrix, tagging, tracker
from quarterdeck.plans import loan_run, shapes


def values(spark, make, inputs):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, c string").orderBy("i")
    return [r[0] for r in df.select(make(F.col("c"))).collect()]


def test_pad12(spark):
    inputs = ["123", "123.0", " 45 ", "1.0.0", "nan", "None", "<NA>", "", None, "abc", "12-34", "1234567890123", "0.0"]
    want = ["000000000123", "000000000123", "000000000045", "000000000010", None, None, None, None, None, None, "000000001234", "1234567890123", "000000000000"]
    assert values(spark, keys.pad12, inputs) == want
    assert values(spark, keys.strip_dash_pad12, ["001-234567", "001-234567.0", "-"]) == ["000001234567", "000001234567", None]


def test_padded_null_words(spark):
    inputs = ["000000000nan", "0000none1", "000000000001", " ", None]
    assert values(spark, keys.drop_padded_nulls, inputs) == [None, None, "000000000001", None, None]


def test_other_keys(spark):
    assert values(spark, keys.zip5, ["12345-6789", "345", "12345.0", "123456.0", "123457", "x", None]) == ["12345", "00345", "12345", "123456", "123457", None, None]
    assert values(spark, keys.fips5, ["1001.0", "36061", ""]) == ["01001", "36061", None]
    assert values(spark, lambda c: keys.period_code_date(F.lit("2024"), c), ["M03", "M13", "A01"]) == [dt.date(2024, 3, 1), None, None]


def test_numbers_and_flags(spark):
    assert values(spark, missing.to_number, ["1,234.5", " 7 ", "NaN", "x", None]) == [1234.5, 7.0, None, None, None]
    assert values(spark, missing.to_flag, ["True", "1", "0", "yes", None]) == [True, True, False, False, False]


def test_division_rules(spark):
    df = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (6.0, None), (None, 3.0), (6.0, -3.0)], "n double, d double")
    got = df.select(
        missing.safe_div0("n", "d").alias("a"), missing.safe_div_fill("n", "d").alias("b"), missing.safe_div_null("n", "d").alias("c"), missing.null_ratio("n", "d").alias("e")
    ).collect()
    assert [tuple(r) for r in got] == [(2, 2, 2, 2), (0, 0, None, None), (None, 0, None, None), (None, 0, None, None), (-2, -2, -2, None)]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Account Number` int, `account-number` int, `a.b$` int")
    assert normalize_names(df).columns == ["ACCOUNT_NUMBER", "ACCOUNT_NUMBER_1", "AB"]
    assert find_column(["X", "Facility Id"], "KEY", ["facility_id"]) == "Facility Id"
    assert find_column(["X"], "KEY") is None
    assert find_role(["Product Type", "Product Area"], "product_area") == "Product Area"
    assert find_role(["Gross"], "gross") == "Gross"
    assert find_role(["Booking Date", "Committee Date"], "date") == "Committee Date"
    assert find_role(["Booking Date", "Committee Date", "Desk Date"], "date", "desk") == "Desk Date"
    assert find_role(["Booking Date", "Committee Date"], "date", "desk") == "Committee Date" and find_role(["Name"], "date", "desk") is None
    assert find_role(["Gross Margin", "Gross Transaction"], "gross") == "Gross Transaction"


def test_ladder(spark):
    df = spark.createDataFrame([(1e9,), (999_999_999.99,), (10_000_001.0,), (10_000_000.99,), (0.0,), (None,)], "x double")
    rows = df.select(tagging.assign_bucket("x"), tagging.bucket_label("x")).collect()
    assert [r[0] for r in rows] == [1_000_000_000, 750_000_000, 10_000_001, 1, 1, 1]
    assert rows[0][1] == "$1,000,000,000"


LOAN = {
    "PRODUCT_BUCKET": None, "CREDIT_LII": None, "IS_NTC": False, "IS_OFFICE": False, "FOCUS_LIST": "Pass", "NEW_CAMP_YN": "N",
    "TXT_MSTR_FACIL_COLLATERAL_DESC": None, "SBL_PERC": None,
}
SCHEMA = "PRODUCT_BUCKET string, CREDIT_LII double, IS_NTC boolean, IS_OFFICE boolean, FOCUS_LIST string, NEW_CAMP_YN string, TXT_MSTR_FACIL_COLLATERAL_DESC string, SBL_PERC double"
KNOWN = [
    (dict(PRODUCT_BUCKET="LAL Diversified", CREDIT_LII=4e8), ["LAL-D >$300MM"]),
    (dict(PRODUCT_BUCKET="TL CRE", CREDIT_LII=8e7, IS_NTC=True, IS_OFFICE=True), ["NTC > $50MM", "TL-CRE >$75MM", "TL-CRE Office >$10MM"]),
    (dict(PRODUCT_BUCKET="RESI", CREDIT_LII=5e6, FOCUS_LIST=" Non-Pass", NEW_CAMP_YN="Y"), ["Non-Pass Originations >$0MM"]),
    (dict(PRODUCT_BUCKET="TL Unsecured", CREDIT_LII=3e7), []),
    (dict(PRODUCT_BUCKET="TL Multicollateral", CREDIT_LII=6e7, TXT_MSTR_FACIL_COLLATERAL_DESC="Hedge Fund and Privately Held shares"), ["TL-Alts HF/PE >$35MM", "TL-Alts Private Shares >$35MM"]),
    # thresholds are inclusive although the names say greater
    (dict(PRODUCT_BUCKET="TL CRE", CREDIT_LII=7.5e7), ["TL-CRE >$75MM"]),
    (dict(PRODUCT_BUCKET="TL Multicollateral", CREDIT_LII=3e8, TXT_MSTR_FACIL_COLLATERAL_DESC="MARKETABLE SECURITIES", SBL_PERC=49.9), ["TL-SBL-D >$300MM"]),
    (dict(PRODUCT_BUCKET="TL Multicollateral", CREDIT_LII=3e8, TXT_MSTR_FACIL_COLLATERAL_DESC="marketable sec", SBL_PERC=50.0), ["TL-SBL-C >$100MM"]),
    (dict(PRODUCT_BUCKET="RESI", CREDIT_LII=None, IS_NTC=True), []),
    (dict(PRODUCT_BUCKET=None, CREDIT_LII=9e9), []),
]


@pytest.mark.parametrize("loan, flags", KNOWN)
def test_flags(spark, loan, flags):
    df = spark.createDataFrame([tuple({**LOAN, **loan}.values())], SCHEMA)
    row = tagging.apply_flags(df).first()
    assert row["FLAG_LIST"] == flags
    assert (row["FLAGS"], row["FLAG_COUNT"], row["QUALIFIED"]) == ("|".join(flags), len(flags), bool(flags))


@pytest.mark.parametrize("salts", [1, 5])
def test_tag_by_key_with_one_hot_key(spark, salts):
    df = spark.range(3000).select(
        F.col("id").alias("LOAN_ID"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k")
    )
    marks = spark.createDataFrame([("hot", True, False), ("hot", False, False), ("4", False, True), (None, True, True), ("9999", True, True)], "key string, a boolean, b boolean")
    got = tagging.tag_by_key(df, marks, "k", salts)
    assert got.columns == ["LOAN_ID", "k", "a", "b"]
    assert got.count() == 3000
    assert got.filter("a").count() == 1000 and [r["LOAN_ID"] for r in got.filter("b").collect()] == [4]


def test_missing_keys_do_not_match(spark, sf):
    prepared = loan_run.prepare(shapes.loan_extract(spark, sf))
    tagged = tagging.with_tags(prepared, shapes.credit_lookup(spark, sf), shapes.reserve_lookup(spark, sf), shapes.property_lookup(spark, sf))
    assert tagged.count() == prepared.count()
    assert tagged.filter("TL_FACILITY_DIGITS12 is null and IS_OFFICE").count() == 0
    assert tagged.filter("TL_FACILITY_DIGITS12 is null").count() > 0


def test_matrix_totals_agree(spark, sf):
    loans = loan_run.tag_loans(shapes.loan_extract(spark, sf), shapes.credit_lookup(spark, sf), shapes.reserve_lookup(spark, sf), shapes.property_lookup(spark, sf))
    total = loans.count()
    views = matrix.view_matrices(loans)
    assert views.count() == 24 * 13
    assert views.agg(F.sum("count_all_all")).first()[0] == total
    assert matrix.matrix_totals(loans).filter("total_level = 3").first()["loans"] == total
    assert loans.filter(F.size("FLAG_LIST") != F.col("FLAG_COUNT")).count() == 0
    diagonal = {r["flag_a"]: r["loans"] for r in matrix.flag_overlap(loans).filter("flag_a = flag_b").collect()}
    counts = {r["flag"]: r["loans"] for r in tagging.flag_counts(loans).collect()}
    assert diagonal == counts
    assert matrix.flag_overlap(loans).count() == 16 * 16


def test_products_outside_the_list_are_counted(spark):
    rows = [(1, "TL CRE", 5.0, "N", False), (1, "Margin", 7.0, "N", True), (1, None, 2.0, "Y", False)]
    loans = spark.createDataFrame(rows, f"{matrix.BUCKET} long, {matrix.PRODUCT} string, {matrix.AMOUNT} double, NEW_CAMP_YN string, QUALIFIED boolean")
    loans = loans.withColumn("LOAN_ID", F.lit(1))
    rest = matrix.view_matrices(loans).filter(f"{matrix.PRODUCT} = 'UNLISTED'").collect()
    assert [(r["count_all_all"], r["sum_all_all"], r["count_new_all"], r["count_all_qualified"]) for r in rest] == [(2, 9.0, 1, 1)]
    assert matrix.commitment_pivot(loans).agg(F.sum("UNLISTED")).first()[0] == 2


def test_quarters_come_from_the_deals(spark):
    counts = spark.createDataFrame([("A", "1995Q1", 2), ("B", "2030Q4", 1)], "kind string, QUARTER string, deals long")
    wide = tracker.periods_wide(counts, "kind", "QUARTER", "deals")
    assert {tuple(r) for r in wide.select("kind", "1995Q1", "2030Q4").collect()} == {("A", 2, 0), ("B", 0, 1)}


def test_new_commitment(spark):
    rows = [("Y", None, None), ("N", 1.0, None), ("N", 0.0, "None"), ("N", None, "Increase"), (None, None, ""), ("N", -1.0, "nan")]
    df = spark.createDataFrame(rows, "NEW_CAMP_YN string, NEW_COMMITMENT_AMOUNT double, NEW_COMMITMENT_REASON string")
    assert [r["NEW_CAMP_YN"] for r in tagging.expand_new_commitment(df).collect()] == ["Y", "Y", "N", "Y", "N", "N"]


def test_tracker(spark):
    rows = [("A", "x", dt.date(2024, 1, 5), 1.0, "Y", None), (" a ", "x", dt.date(2024, 2, 5), 2.0, None, "y"), ("", "B", dt.date(2024, 4, 5), 3.0, "N", ""), (None, "b", None, 4.0, "Y", "Y")]
    df = spark.createDataFrame(rows, "name string, alt string, d date, size double, FA_ONE string, FA_TWO string")
    kept = tracker.dedup_latest(df, "name", "alt", "d", ["size"])
    assert {(r["BORROWER_KEY"], r["QUARTER"], r["size"]) for r in kept.collect()} == {("A", "2024Q1", 2.0), ("B", "2024Q2", 3.0)}
    combined, left = tracker.combine_families(kept, ["FA_ONE", "FA_TWO"])
    assert left == ["FA_COMBINED"]
    heat = {(r["QUARTER"], r["flag"]): r["yes_count"] for r in tracker.flag_heatmap(combined, left).collect()}
    assert heat == {("2024Q1", "FA_COMBINED"): 1, ("2024Q2", "FA_COMBINED"): 0}


def test_join_rates_read_the_loans_once(spark, sf, folder):
    """Alone in one pass; in the run while the loans are written. A hot empty key and keys without a lookup count like any other."""
    parts = shapes.loan_extract(spark, sf), shapes.credit_lookup(spark, sf), shapes.reserve_lookup(spark, sf), shapes.property_lookup(spark, sf)
    parts[0].write.parquet(f"{folder}/loans")
    extract = spark.read.parquet(f"{folder}/loans")
    alone = tagging.join_rates(tagging.clean_extract(extract), *parts[1:])
    want = {r["lookup"]: tuple(r)[1:] for r in alone.collect()}
    scans = [t for n, t in ran(alone) if n.startswith("Scan parquet") and "PRODUCT_BUCKET" in t]
    assert len(scans) == 1 and set(want) == {"credit", "reserve", "property"}
    plain = tagging.clean_extract(extract).select("PRODUCT_BUCKET", "ACCOUNT_NUMBER", "TL_FACILITY_DIGITS12").collect()
    keys_of = {n: {r["key"] for r in rows.collect()} for n, rows in tagging.lookup_keys(*parts[1:]).items()}
    for name, (key, scope) in tagging.LOOKUPS.items():
        found = [r[key] for r in plain if r["PRODUCT_BUCKET"] in scope]
        hits = sum(k is not None and k in keys_of[name] for k in found)
        assert want[name] == (len(found), hits, pytest.approx(hits * 100 / len(found)))
    run = loan_run.write_tagged(extract, *parts[1:], f"{folder}/tagged", "parquet")
    assert {r["lookup"]: tuple(r)[1:] for r in run.collect()} == want
    written = spark.read.parquet(f"{folder}/tagged")
    assert not set(tagging.KNOWN.values()) & set(written.columns) and written.count() == len(plain)
    empty = [p.limit(0) for p in parts]
    assert {tuple(r) for r in tagging.join_rates(tagging.clean_extract(empty[0]), *empty[1:]).collect()} == {(n, 0, 0, None) for n in tagging.LOOKUPS}
