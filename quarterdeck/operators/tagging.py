"""Cleaning a loan extract, tagging it from lookup files and evaluating threshold flags."""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quarterdeck.functions.keys import pad12, strip_dash_pad12
from quarterdeck.functions.missing import present, to_flag, to_number

# Product families.
LAL_PRODUCTS = ["LAL Diversified", "LAL Highly Conc.", "LAL NFPs"]
TL_PRODUCTS = [
    "TL Aircraft", "TL CRE", "TL Life Insurance", "TL Multicollateral", "TL Other Secured", "TL PHA",
    "TL SBL Diversified", "TL SBL Highly Conc.", "TL Unsecured",
]
PRODUCTS = [*LAL_PRODUCTS, "RESI", *TL_PRODUCTS]

# Floors of the commitment ladder.
BUCKET_FLOORS = [
    1_000_000_000, 750_000_000, 700_000_000, 600_000_000, 500_000_000, 400_000_000, 350_000_000, 300_000_000,
    250_000_000, 200_000_000, 175_000_000, 150_000_000, 125_000_000, 100_000_000, 75_000_000, 50_000_000,
    40_000_000, 35_000_000, 30_000_000, 25_000_000, 20_000_000, 15_000_000, 10_000_001, 1,
]

# Words that mark an entity relationship.
ENTITY_WORDS = [
    "organization", "limited liability", "corporation", "limited partnership", "guarantor", "trust", "estate",
    "joint venture", "partnership", "association",
]

# Flag names and the rule of each, over the tagged columns. ``has_*`` are
# case-insensitive keyword hits on the collateral text, ``amount`` the commitment.
_MULTI = "PRODUCT_BUCKET = 'TL Multicollateral'"
_TL = "PRODUCT_BUCKET IN ({})".format(", ".join(f"'{p}'" for p in TL_PRODUCTS))
_LAL_TL = "PRODUCT_BUCKET IN ({})".format(", ".join(f"'{p}'" for p in [*LAL_PRODUCTS, *TL_PRODUCTS]))
FLAG_RULES = {
    "NTC > $50MM": f"{_LAL_TL} AND IS_NTC AND amount >= 50000000",
    "Non-Pass Originations >$0MM": "trim(FOCUS_LIST) = 'Non-Pass' AND upper(trim(NEW_CAMP_YN)) = 'Y'",
    "TL-CRE >$75MM": "PRODUCT_BUCKET = 'TL CRE' AND amount >= 75000000",
    "TL-CRE Office >$10MM": "PRODUCT_BUCKET = 'TL CRE' AND IS_OFFICE AND amount >= 10000000",
    "TL-SBL-D >$300MM": f"amount >= 300000000 AND (PRODUCT_BUCKET = 'TL SBL Diversified' OR ({_MULTI} AND has_marketable AND share < 50))",
    "TL-SBL-C >$100MM": f"amount >= 100000000 AND (PRODUCT_BUCKET = 'TL SBL Highly Conc.' OR ({_MULTI} AND has_marketable AND share >= 50))",
    "TL-LIC >$100MM": "PRODUCT_BUCKET = 'TL Life Insurance' AND amount >= 100000000",
    "TL-Alts HF/PE >$35MM": f"{_TL} AND has_hedge AND amount >= 35000000",
    "TL-Alts Private Shares >$35MM": f"amount >= 35000000 AND (PRODUCT_BUCKET = 'TL PHA' OR ({_MULTI} AND has_private))",
    "TL-Alts Unsecured >$35MM": f"amount >= 35000000 AND (PRODUCT_BUCKET = 'TL Unsecured' OR ({_MULTI} AND has_unsecured))",
    "TL-Alts PAF >$50MM": f"{_TL} AND has_aircraft AND amount >= 50000000",
    "TL-Alts Fine Art >$50MM": f"{_TL} AND has_fine_art AND amount >= 50000000",
    "TL-Alts Other Secured >$50MM": f"amount >= 50000000 AND (PRODUCT_BUCKET = 'TL Other Secured' OR ({_MULTI} AND has_other))",
    "LAL-D >$300MM": "PRODUCT_BUCKET = 'LAL Diversified' AND amount >= 300000000",
    "LAL-C >$100MM": "PRODUCT_BUCKET = 'LAL Highly Conc.' AND amount >= 100000000",
    "RESI >$10MM": "PRODUCT_BUCKET = 'RESI' AND amount >= 10000000",
}
FLAG_NAMES = list(FLAG_RULES)
KEYWORDS = {
    "has_marketable": "marketable sec",
    "has_hedge": "hedge",
    "has_private": "privately held",
    "has_unsecured": "unsecured",
    "has_aircraft": "aircraft",
    "has_fine_art": "fine art",
    "has_other": "other",
}


def clean_extract(df: DataFrame) -> DataFrame:
    """Typed loan rows: 12-digit keys, numbers and booleans.

    The facility id is filled from the 12-digit facility key. The tags join on that key itself,
    so it is not filled from anything.
    """
    padded = df.withColumns(
        {
            "TL_FACILITY_DIGITS12": pad12("TL_FACILITY_DIGITS12"),
            "FACILITY_ID": pad12("FACILITY_ID"),
            "ACCOUNT_NUMBER": pad12("ACCOUNT_NUMBER"),
        }
    )
    return padded.withColumns(
        {
            "FACILITY_ID": F.coalesce("FACILITY_ID", "TL_FACILITY_DIGITS12"),
            "IS_LAL_NFP": to_flag("IS_LAL_NFP"),
            "CREDIT_LII": to_number("CREDIT_LII"),
            "BALANCE": to_number("BALANCE"),
            "SBL_PERC": to_number("SBL_PERC"),
            "NEW_COMMITMENT_AMOUNT": to_number("NEW_COMMITMENT_AMOUNT"),
        }
    )


def _ladder(amount: Column | str, step: Callable[[int], Column]) -> Column:
    """``step`` of the first floor at or under the amount; NULL and anything below get the lowest."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    chain = F.when(amount >= BUCKET_FLOORS[0], step(BUCKET_FLOORS[0]))
    for floor in BUCKET_FLOORS[1:]:
        chain = chain.when(amount >= floor, step(floor))
    return chain.otherwise(step(BUCKET_FLOORS[-1]))


def assign_bucket(amount: Column | str) -> Column:
    return _ladder(amount, lambda floor: F.lit(floor).cast("long"))


def bucket_label(amount: Column | str) -> Column:
    return _ladder(amount, lambda floor: F.lit(f"${floor:,}"))


def with_buckets(df: DataFrame, amount: str = "CREDIT_LII") -> DataFrame:
    return df.withColumns(
        {"CREDIT_LII_COMMITMENT_FLOOR": assign_bucket(amount), "CREDIT_LII_COMMITMENT_BUCKET": bucket_label(amount)}
    )


def expand_new_commitment(df: DataFrame) -> DataFrame:
    """Y when already Y, when the new amount is positive or when a real reason is given."""
    reason = F.upper(F.coalesce("NEW_COMMITMENT_REASON", F.lit("")))
    new = (
        F.coalesce(F.col("NEW_CAMP_YN") == "Y", F.lit(False))
        | (F.coalesce(F.col("NEW_COMMITMENT_AMOUNT"), F.lit(0.0)) > 0)
        | ~reason.isin("", "NONE", "NAN")
    )
    return df.withColumn("NEW_CAMP_YN", F.when(new, "Y").otherwise("N"))


# Columns whose hash tells loans apart well enough to spread rows without a key.
SPREAD_COLUMNS = ["LOAN_ID", "KEY_ACCT", "ACCOUNT_NUMBER", "TL_FACILITY_DIGITS12", "BORROWER", "CREDIT_LII"]


def tag_by_key(df: DataFrame, marks: DataFrame, key: str, salts: int = 1) -> DataFrame:
    """Left join of boolean marks: ``marks`` holds a ``key`` column and one boolean per tag.

    A key without any mark, and a NULL key, get False. The marks are reduced to one row per key
    first and never forced into a broadcast: Spark broadcasts them when their measured size
    allows, else shuffles both sides and AQE splits hot partitions. Rows without a key are
    spread over made-up keys so that they do not meet in one task; ``salts`` > 1 also splits
    every real key, for clusters that run without AQE.
    """
    names = [c for c in marks.columns if c != "key"]
    known = marks.filter(F.col("key").isNotNull() & reduce(lambda a, b: a | b, [F.col(n) for n in names]))
    hits = known.groupBy(F.col("key").alias("_k")).agg(*[F.bool_or(n).alias(f"_hit_{n}") for n in names])
    row_hash = F.xxhash64(*[F.col(c) for c in present(df.columns, SPREAD_COLUMNS) or df.columns])
    left = df.withColumn("_j", F.coalesce(F.col(key), F.concat(F.lit("\u0000"), row_hash.cast("string"))))
    on = F.col("_j") == F.col("_k")
    if salts > 1:
        left = left.withColumn("_s", F.pmod(row_hash, F.lit(salts)).cast("int"))
        hits = hits.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("_s") == F.col("_t"))
    joined = left.join(hits, on, "left")
    tags = {n: F.coalesce(f"_hit_{n}", F.lit(False)) for n in names}
    return joined.withColumns(tags).drop("_j", "_k", "_s", "_t", *[f"_hit_{n}" for n in names])


def _yes(c: str) -> Column:
    return F.coalesce(F.lower(F.trim(c)) == "yes", F.lit(False))


def operating_or_charity(credit: DataFrame) -> Column:
    """Accounts of operating companies and charities."""
    charity = next((c for c in credit.columns if "CHARITY" in c and "ORGANIZATION" in c), None)
    wanted = _yes("OPERATING_COMPANY") if "OPERATING_COMPANY" in credit.columns else F.lit(False)
    return wanted | _yes(charity) if charity else wanted


def any_exception(credit: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Yes in any exception column."""
    columns = [c for c in (columns or credit.columns) if c in credit.columns and (columns or "EXCEPTION" in c)]
    return reduce(lambda a, b: a | b, [_yes(c) for c in columns], F.lit(False))


# For the audit: whether a lookup knows a loan's key at all.
KNOWN = {"credit": "KNOWN_TO_CREDIT", "reserve": "KNOWN_TO_RESERVE", "property": "KNOWN_TO_PROPERTY"}


def account_marks(credit: DataFrame, audit: bool = False) -> DataFrame:
    """Both account tags from one pass over the credit lookup."""
    return credit.select(
        strip_dash_pad12("ACCOUNT_NUMBER").alias("key"),
        operating_or_charity(credit).alias("_in_credit"),
        any_exception(credit).alias("HAS_CREDIT_POLICY_EXCEPTION"),
        *([F.lit(True).alias(KNOWN["credit"])] if audit else []),
    )


def facility_marks(reserve: DataFrame, properties: DataFrame, audit: bool = False) -> DataFrame:
    """Facilities with a corporate purpose and an entity relationship, and facilities on offices."""
    known = lambda here: [F.lit(n == here).alias(KNOWN[n]) for n in ("reserve", "property")] if audit else []
    purpose = F.col("PURPOSE_CODE_DESCRIPTION").rlike("(?i)corp")
    entity = F.col("ACCOUNT_RELATIONSHIP_CODE_DESCRIPTION").rlike("(?i)" + "|".join(ENTITY_WORDS))
    office = F.lower("PROPERTY_TYPE").contains("office")
    corporate = reserve.select(
        pad12("FACILITY_ACCOUNT_NUMBER").alias("key"),
        F.coalesce(purpose & entity, F.lit(False)).alias("_in_reserve"),
        F.lit(False).alias("IS_OFFICE"),
        *known("reserve"),
    )
    offices = properties.select(
        pad12("FACILITY_ID").alias("key"),
        F.lit(False).alias("_in_reserve"),
        F.coalesce(office, F.lit(False)).alias("IS_OFFICE"),
        *known("property"),
    )
    return corporate.unionByName(offices)


def with_tags(df: DataFrame, credit: DataFrame, reserve: DataFrame, properties: DataFrame, salts: int = 1, audit: bool = False) -> DataFrame:
    """The three tags, with one join per key: all account tags together, all facility tags together.

    An empty lookup just yields False, so optional inputs may be empty frames. ``audit`` adds the columns of ``KNOWN`` by the same joins.
    """
    tagged = tag_by_key(df, account_marks(credit, audit), "ACCOUNT_NUMBER", salts)
    tagged = tag_by_key(tagged, facility_marks(reserve, properties, audit), "TL_FACILITY_DIGITS12", salts)
    a = F.col("PRODUCT_BUCKET").isin(LAL_PRODUCTS) & (F.col("IS_LAL_NFP") | F.col("_in_credit"))
    b = F.col("PRODUCT_BUCKET").isin(TL_PRODUCTS) & F.col("_in_reserve")
    return tagged.withColumn("IS_NTC", F.coalesce(a | b, F.lit(False))).drop("_in_credit", "_in_reserve")


def flag_list(flags: str) -> Column:
    """Pipe-joined flags as an array; the empty text is the empty array."""
    return F.when(F.col(flags) == "", F.array().cast("array<string>")).otherwise(F.split(flags, "[|]"))


def apply_flags(df: DataFrame) -> DataFrame:
    """All flags as an array, as pipe-joined text, their number, and whether there is any.

    Keyword hits, then one boolean per rule, then the outputs: each rule is evaluated once.
    """
    text = F.lower("TXT_MSTR_FACIL_COLLATERAL_DESC")
    inputs = {name: F.coalesce(text.contains(word), F.lit(False)) for name, word in KEYWORDS.items()}
    inputs["amount"] = F.coalesce(F.col("CREDIT_LII"), F.lit(0.0))
    inputs["share"] = F.coalesce(F.col("SBL_PERC"), F.lit(0.0))
    hits = {f"_f{i}": F.expr(f"coalesce({rule}, false)") for i, rule in enumerate(FLAG_RULES.values())}
    out = df.withColumns(inputs).withColumns(hits)
    joined = F.concat_ws("|", *[F.when(F.col(f), F.lit(name)) for f, name in zip(hits, FLAG_NAMES)])
    out = out.withColumns(
        {"FLAGS": joined, "FLAG_COUNT": reduce(lambda a, b: a + b, [F.col(f).cast("int") for f in hits])}
    )
    return out.withColumns({"FLAG_LIST": flag_list("FLAGS"), "QUALIFIED": F.col("FLAG_COUNT") > 0}).drop(*inputs, *hits)


# lookup: (key of the loans, products in scope)
LOOKUPS = {
    "credit": ("ACCOUNT_NUMBER", LAL_PRODUCTS),
    "reserve": ("TL_FACILITY_DIGITS12", TL_PRODUCTS),
    "property": ("TL_FACILITY_DIGITS12", TL_PRODUCTS),
}


def lookup_keys(credit: DataFrame, reserve: DataFrame, properties: DataFrame) -> dict[str, DataFrame]:
    """The keys each lookup knows, as a frame ``key``."""
    return {
        "credit": credit.select(strip_dash_pad12("ACCOUNT_NUMBER").alias("key")),
        "reserve": reserve.select(pad12("FACILITY_ACCOUNT_NUMBER").alias("key")),
        "property": properties.select(pad12("FACILITY_ID").alias("key")),
    }


def rate_rows(counts: DataFrame) -> DataFrame:
    """One row ``total_<lookup>, matched_<lookup>, ...`` as a row per lookup with the share."""
    parts = [F.struct(F.lit(n).alias("lookup"), F.coalesce(f"total_{n}", F.lit(0)).alias("total"), F.coalesce(f"matched_{n}", F.lit(0)).alias("matched")) for n in LOOKUPS]
    rate = F.try_divide(F.col("matched") * F.lit(100.0), F.col("total")).alias("join_rate_pct")
    return counts.select(F.explode(F.array(*parts)).alias("p")).select("p.*").select("*", rate)


def join_rates(df: DataFrame, credit: DataFrame, reserve: DataFrame, properties: DataFrame) -> DataFrame:
    """Per lookup: rows in scope, rows whose key the lookup knows, and the share.

    The loans are read once: each is counted under the keys it looks up, per (lookup, key), before that meets the lookups in one
    join. Both sides hold a key once and none is hot.
    """
    wanted = [F.when(F.col("PRODUCT_BUCKET").isin(scope), F.struct(F.lit(n).alias("lookup"), F.col(key).alias("key"))) for n, (key, scope) in LOOKUPS.items()]
    per_key = df.select(F.explode(F.array_compact(F.array(*wanted))).alias("w")).groupBy("w.lookup", "w.key").agg(F.count(F.lit(1)).alias("n"))
    keys = [rows.distinct().select(F.lit(n).alias("lookup"), "key", F.lit(True).alias("_hit")) for n, rows in lookup_keys(credit, reserve, properties).items()]
    hit = per_key.join(reduce(DataFrame.unionByName, keys), ["lookup", "key"], "left")
    sums = [F.sum(F.when(F.col("lookup") == n, F.col("n"))).alias(f"total_{n}") for n in LOOKUPS]
    sums += [F.sum(F.when((F.col("lookup") == n) & F.col("_hit"), F.col("n"))).alias(f"matched_{n}") for n in LOOKUPS]
    return rate_rows(hit.agg(*sums))


def join_rate_metrics() -> list[Column]:
    """The counts behind :func:`join_rates` as aggregates over loans tagged with ``audit``, to be observed while they are written."""
    scope = {n: F.col("PRODUCT_BUCKET").isin(products) for n, (_, products) in LOOKUPS.items()}
    totals = [F.count_if(scope[n]).alias(f"total_{n}") for n in LOOKUPS]
    return totals + [F.count_if(scope[n] & F.col(KNOWN[n])).alias(f"matched_{n}") for n in LOOKUPS]


def flag_counts(df: DataFrame) -> DataFrame:
    """Rows and amount per flag, zero for flags nobody got."""
    aggs = []
    for i, name in enumerate(FLAG_NAMES):
        has = F.array_contains("FLAG_LIST", name)
        aggs += [F.count_if(has).alias(f"n{i}"), F.sum(F.when(has, F.col("CREDIT_LII"))).alias(f"s{i}")]
    one = df.agg(*aggs)
    parts = [
        F.struct(F.lit(name).alias("flag"), F.col(f"n{i}").alias("loans"), F.coalesce(f"s{i}", F.lit(0.0)).alias("amount"))
        for i, name in enumerate(FLAG_NAMES)
    ]
    return one.select(F.explode(F.array(*parts)).alias("p")).select("p.*").withColumn("zero_hit", F.col("loans") == 0)


def flag_summary(df: DataFrame) -> DataFrame:
    """Qualified rows, their share, rows with several flags and distinct flags, in one row."""
    distinct = sum((F.max(F.array_contains("FLAG_LIST", name).cast("int")) for name in FLAG_NAMES[1:]), F.max(F.array_contains("FLAG_LIST", FLAG_NAMES[0]).cast("int")))
    return df.agg(
        F.count(F.lit(1)).alias("loans"),
        F.count_if("QUALIFIED").alias("qualified"),
        F.try_divide(F.count_if("QUALIFIED") * F.lit(100.0), F.count(F.lit(1))).alias("qualified_pct"),
        F.count_if(F.col("FLAG_COUNT") > 1).alias("multi_flag"),
        distinct.alias("distinct_flags"),
    )
