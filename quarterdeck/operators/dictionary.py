"""Metric dictionary: exact and prefix-stripped lookup over three tiers of definitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Call-report mnemonic prefixes.
PREFIXES = ["RCFD", "RCON", "RIAD", "RCFA", "RCOA", "RCFN", "RCFW", "RCOW"]
SOURCES = {1: "Tier 1", 2: "Tier 2", 3: "Tier 3"}


def normal(c: str) -> Column:
    return F.upper(F.trim(c))


def base_item(c: Column) -> Column:
    """Code without its prefix; unchanged when there is none."""
    return F.regexp_replace(c, "^(" + "|".join(PREFIXES) + ")", "")


def lookup(codes: DataFrame, tiers: dict[int, DataFrame], code: str = "code") -> DataFrame:
    """Definition of every code: tier 1 exact, tier 1 stripped, tier 2 exact, tier 2 stripped, tier 3, not found.

    Tiers hold (code, name, description), one row per code. Each code keeps the definition of
    lowest rank, found by an aggregate.
    """
    wanted = codes.select(F.col(code).alias("metric_code"), normal(code).alias("_k")).distinct()
    wanted = wanted.withColumn("_b", base_item(F.col("_k")))
    steps = [(1, "_k", 1), (1, "_b", 2), (2, "_k", 3), (2, "_b", 4), (3, "_k", 5)]
    hits = []
    for tier, column, rank in steps:
        defs = tiers[tier].select(normal("code").alias(column), "name", "description")
        rows = wanted if column == "_k" else wanted.filter("_b <> _k")
        suffix = " (base item)" if column == "_b" else ""
        hits.append(
            rows.join(defs, column).select(
                "metric_code",
                F.lit(rank).alias("rank"),
                "name",
                "description",
                F.lit(SOURCES[tier] + suffix).alias("source"),
                F.lit(tier == 3).alias("is_derived"),
            )
        )
    best = (
        reduce(DataFrame.unionByName, hits)
        .groupBy("metric_code")
        .agg(F.min_by(F.struct("name", "description", "source", "is_derived"), "rank").alias("d"))
    )
    return wanted.join(best, "metric_code", "left").select(
        "metric_code",
        F.coalesce("d.name", "_k").alias("name"),
        F.coalesce("d.description", F.lit("Definition Not Found")).alias("description"),
        F.coalesce("d.source", F.lit("Not Found")).alias("source"),
        F.coalesce("d.is_derived", F.lit(False)).alias("is_derived"),
    )


def export(tiers: dict[int, DataFrame]) -> DataFrame:
    """Every known definition once, the lower tier winning."""
    rows = [
        df.select(normal("code").alias("metric_code"), "name", "description", F.lit(SOURCES[t]).alias("source"), F.lit(t == 3).alias("is_derived"), F.lit(t).alias("_t"))
        for t, df in tiers.items()
    ]
    known = reduce(DataFrame.unionByName, rows)
    best = known.groupBy("metric_code").agg(F.min_by(F.struct("name", "description", "source", "is_derived"), "_t").alias("d"))
    return best.select("metric_code", "d.*")
