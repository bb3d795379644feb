"""Commitment matrices, bands, overlaps and lists over tagged loans.

Groups here are (bucket, product) cells and flag sets: a few hundred at most, all reduced on
the map side, so a cell holding a third of all loans is no different from a small one.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quarterdeck.operators.tagging import BUCKET_FLOORS, FLAG_NAMES, LAL_PRODUCTS, PRODUCTS, flag_list

BUCKET = "CREDIT_LII_COMMITMENT_FLOOR"
PRODUCT = "PRODUCT_BUCKET"
AMOUNT = "CREDIT_LII"
UNLISTED = "UNLISTED"

# Threshold of each product.
THRESHOLDS = {
    "LAL Diversified": 300_000_000, "LAL Highly Conc.": 100_000_000, "LAL NFPs": 50_000_000,
    "TL SBL Diversified": 300_000_000, "TL SBL Highly Conc.": 100_000_000, "TL Life Insurance": 100_000_000,
    "TL CRE": 75_000_000, "TL Unsecured": 35_000_000, "TL Aircraft": 50_000_000, "TL PHA": 35_000_000,
    "TL Other Secured": 50_000_000, "TL Multicollateral": 50_000_000, "RESI": 10_000_000,
}
VIEWS = {
    "all_all": "true",
    "new_all": "NEW_CAMP_YN = 'Y'",
    "all_qualified": "QUALIFIED",
    "new_qualified": "NEW_CAMP_YN = 'Y' AND QUALIFIED",
}


def amount() -> Column:
    return F.coalesce(F.col(AMOUNT), F.lit(0.0))


def threshold() -> Column:
    """Threshold of the row's product, NULL for products without one."""
    pairs = [F.lit(x) for p, t in THRESHOLDS.items() for x in (p, float(t))]
    return F.try_element_at(F.create_map(*pairs), F.col(PRODUCT))


def listed() -> Column:
    """The row's product, ``UNLISTED`` where it is none of the list."""
    return F.when(F.col(PRODUCT).isin(PRODUCTS), F.col(PRODUCT)).otherwise(F.lit(UNLISTED))


def cells(df: DataFrame) -> DataFrame:
    """The full bucket x product grid of the ladder and the product list."""
    one = df.sparkSession.range(1)
    return (
        one.select(F.explode(F.array(*[F.lit(f).cast("long") for f in BUCKET_FLOORS])).alias(BUCKET))
        .withColumn(PRODUCT, F.explode(F.array(*[F.lit(p) for p in PRODUCTS])))
    )


def view_matrices(df: DataFrame) -> DataFrame:
    """Count and amount of every cell in the four views, zeros included; one pass over the loans.

    Loans of a product outside the list, or without one, are counted in rows ``UNLISTED``, so that cells add up to the totals.
    """
    aggs = []
    for view, rule in VIEWS.items():
        aggs.append(F.count_if(F.expr(rule)).alias(f"count_{view}"))
        aggs.append(F.sum(F.when(F.expr(rule), amount())).alias(f"sum_{view}"))
    made = df.withColumn(PRODUCT, listed()).groupBy(BUCKET, PRODUCT).agg(*aggs)
    # Both sides have at most one row per cell of the fixed grid and its remainder.
    joined = cells(df).join(made, [BUCKET, PRODUCT], "full")
    zero = {f"count_{v}": F.coalesce(f"count_{v}", F.lit(0)) for v in VIEWS}
    zero |= {f"sum_{v}": F.coalesce(f"sum_{v}", F.lit(0.0)) for v in VIEWS}
    return joined.withColumns(zero)


def commitment_pivot(df: DataFrame, measure: str = "count", where: str = "true") -> DataFrame:
    """One row per bucket and one column per product and for ``UNLISTED`` ones, zeros filled."""
    agg = F.count(F.lit(1)) if measure == "count" else F.sum(amount())
    wide = df.filter(F.expr(where)).withColumn(PRODUCT, listed()).groupBy(BUCKET).pivot(PRODUCT, [*PRODUCTS, UNLISTED]).agg(agg)
    grid = cells(df).select(BUCKET).distinct()
    joined = grid.join(F.broadcast(wide), BUCKET, "left")
    zero = F.lit(0) if measure == "count" else F.lit(0.0)
    return joined.select(BUCKET, *[F.coalesce(F.col(f"`{p}`"), zero).alias(p) for p in [*PRODUCTS, UNLISTED]])


def matrix_totals(df: DataFrame) -> DataFrame:
    """Cells, row totals, column totals and the grand total; ``total_level`` is 0, 1 (product rolled up), 2 or 3."""
    grid = df.groupBy(BUCKET, PRODUCT).agg(F.count(F.lit(1)).alias("loans"), F.sum(amount()).alias("amount"))
    return grid.cube(BUCKET, PRODUCT).agg(
        F.grouping_id().cast("int").alias("total_level"), F.sum("loans").alias("loans"), F.sum("amount").alias("amount")
    )


def threshold_bands(df: DataFrame) -> DataFrame:
    """Per product: number and amount below 80 %, from 80 to 100 % and at or over its threshold."""
    t, x = threshold(), amount()
    bands = {"below": x < t * 0.8, "approaching": (x >= t * 0.8) & (x < t), "at_above": x >= t}
    aggs = []
    for name, cond in bands.items():
        aggs += [F.count_if(cond).alias(f"n_{name}"), F.coalesce(F.sum(F.when(cond, x)), F.lit(0.0)).alias(f"sum_{name}")]
    return df.groupBy(PRODUCT).agg(*aggs)


def qualified_split(df: DataFrame) -> DataFrame:
    return df.groupBy("QUALIFIED").agg(F.count(F.lit(1)).alias("loans"), F.sum(amount()).alias("amount"))


def flag_sets(df: DataFrame) -> DataFrame:
    """Distinct flag combinations with their rows and amount - the small table behind every flag report."""
    sets = df.groupBy("FLAGS").agg(F.count(F.lit(1)).alias("loans"), F.sum(amount()).alias("amount"))
    return sets.withColumn("FLAG_LIST", flag_list("FLAGS"))


def flag_breakdown(df: DataFrame, top: int = 12) -> DataFrame:
    """The most frequent flags with their amount."""
    return (
        flag_sets(df)
        .select(F.explode("FLAG_LIST").alias("flag"), "loans", "amount")
        .groupBy("flag")
        .agg(F.sum("loans").alias("loans"), F.sum("amount").alias("amount"))
        .orderBy(F.col("loans").desc(), "flag")
        .limit(top)
    )


def flag_overlap(df: DataFrame) -> DataFrame:
    """Rows carrying both flags of a pair, zeros included; the diagonal is the flag's own count.

    Pairs come from the distinct flag sets, not from the loans.
    """
    names = F.array(*[F.lit(n) for n in FLAG_NAMES])
    grid = df.sparkSession.range(1).select(F.explode(names).alias("flag_a")).withColumn("flag_b", F.explode(names))
    seen = (
        flag_sets(df)
        .select("FLAG_LIST", "loans")
        .select(F.explode("FLAG_LIST").alias("flag_a"), "FLAG_LIST", "loans")
        .select("flag_a", F.explode("FLAG_LIST").alias("flag_b"), "loans")
        .groupBy("flag_a", "flag_b")
        .agg(F.sum("loans").alias("loans"))
    )
    # Both sides have at most one row per pair of rules.
    joined = grid.join(F.broadcast(seen), ["flag_a", "flag_b"], "left")
    return joined.withColumn("loans", F.coalesce("loans", F.lit(0).cast("long")))


def concentration(df: DataFrame, denominator_rule: str = "all", lowest_free: Sequence[str] = LAL_PRODUCTS) -> DataFrame:
    """Amount at or over the threshold over all amount, per product and weighted in total.

    ``denominator_rule='above_lowest'`` leaves the lowest bucket out of the denominator of
    the products in ``lowest_free``.
    """
    x = amount()
    counted = x
    if denominator_rule == "above_lowest":
        skip = F.col(PRODUCT).isin(list(lowest_free)) & (F.col(BUCKET) == BUCKET_FLOORS[-1])
        counted = F.when(skip, F.lit(0.0)).otherwise(x)
    per = df.groupBy(PRODUCT).agg(
        F.sum(F.when(x >= threshold(), x).otherwise(F.lit(0.0))).alias("at_above"), F.sum(counted).alias("total")
    )
    ratio = F.coalesce(F.try_divide(F.col("at_above"), F.col("total")), F.lit(0.0))
    total = per.agg(F.lit("TOTAL").alias(PRODUCT), F.sum("at_above").alias("at_above"), F.sum("total").alias("total"))
    return per.unionByName(total).withColumn("concentration", ratio)


def top_loans(df: DataFrame, n: int = 10, key: str = "LOAN_ID") -> DataFrame:
    return df.orderBy(F.col(AMOUNT).desc_nulls_last(), key).limit(n)


def nearest_threshold(df: DataFrame, n: int = 30, low: float = 0.7, high: float = 3.0, key: str = "LOAN_ID") -> DataFrame:
    """Loans between ``low`` and ``high`` times their threshold, closest to it first."""
    scored = df.withColumns({"threshold": threshold(), "pct": F.try_divide(amount(), threshold())})
    near = scored.filter(F.col("pct").between(low, high)).withColumn("distance", amount() - F.col("threshold"))
    return near.orderBy(F.abs(F.col("pct") - 1), key).limit(n)


def drill_through(
    df: DataFrame, bucket: int | None = None, product: str | None = None, new_only: bool = False, qualified_only: bool = False
) -> DataFrame:
    """Rows behind one cell of a view. The bucket becomes an amount range, which can reach the scan."""
    if bucket is not None:
        above = [f for f in BUCKET_FLOORS if f > bucket]
        in_range = amount() < min(above) if above else F.lit(True)
        if bucket != BUCKET_FLOORS[-1]:
            in_range = in_range & (amount() >= bucket)
        df = df.filter(in_range)
    if product is not None:
        df = df.filter(F.col(PRODUCT) == product)
    if new_only:
        df = df.filter("NEW_CAMP_YN = 'Y'")
    return df.filter("QUALIFIED") if qualified_only else df
