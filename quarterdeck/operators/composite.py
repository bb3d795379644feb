"""Synthetic peer entities: group averages per period, with audits of what went in."""

from __future__ import annotations

import re
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quarterdeck.functions.missing import present
from quarterdeck.operators.flows import ENTITY, PERIOD

# Names that mark a rate when no metric dimension says so.
RATE_NAME = re.compile(
    r"(_Rate$|_Ratio$|_Coverage$|_Pct$|_Share$|_Composition$|_Yield|_Adj_|ROA|ROE|NIM|Efficiency|Leverage|Liquidity|HQLA|"
    r"Cash_to|Securities_to|Loans_to|Equity_to|Norm_NCO|Norm_Nonaccrual|Norm_Delinquency|Norm_ACL|Norm_Loan|Norm_Provision|"
    r"Norm_Loss|Norm_Risk_Adj)",
    re.I,
)
# Rates a normalised composite must not carry.
STANDARD_RATES = [
    "TTM_NCO_Rate",
    "NPL_to_Gross_Loans_Rate",
    "Nonaccrual_to_Gross_Loans_Rate",
    "Past_Due_Rate",
    "Allowance_to_Gross_Loans_Rate",
    "Risk_Adj_Allowance_Coverage",
]
# Rates the name rule misses; listed so that they are not summed or averaged as amounts.
RATE_EXTRAS = re.compile(r"(_Growth_|_Mismatch$|_Years_of_Reserves$|_Share_of_Total_PD|_Velocity$|_Elasticity$)")


def metric_kind(name: str, kinds: Mapping[str, str] | None = None) -> str:
    """``rate`` or ``level``; an explicit dimension wins over the name rule."""
    if kinds and name in kinds:
        return kinds[name]
    return "rate" if RATE_NAME.search(name) or RATE_EXTRAS.search(name) else "level"


def weighted_mean(c: str, weight: str) -> Column:
    """Sum of value times weight over sum of weights (NULL counts 0); plain mean when the weights sum to 0."""
    w = f"coalesce(`{weight}`, 0D)"
    return F.expr(
        f"CASE WHEN sum({w}) > 0 THEN try_divide(sum(coalesce(`{c}`, 0D) * {w}), sum({w})) ELSE avg(`{c}`) END"
    )


def composites(
    df: DataFrame,
    bridge: DataFrame,
    metrics: Sequence[str],
    method: str = "mean",
    weight: str | None = None,
    kinds: Mapping[str, str] | None = None,
    id_base: int = 90000,
    blank_regime: bool = True,
    entity: str = ENTITY,
    period: str = PERIOD,
) -> DataFrame:
    """One row per (group, period), id = ``id_base`` + display order, named ``AVG: group``.

    ``bridge`` holds (group_key, entity, display_order, use_normalized). Averages combine on
    the map side, so a group that holds most entities costs no more than a small one. Under
    ``weighted`` rates are weighted by ``weight`` (loans, else assets).
    """
    metrics = present(df.columns, metrics)
    if weight is None:
        weight = next(iter(present(df.columns, ["LNLS", "ASSET"])), None)
    use_weights = method == "weighted" and weight is not None
    aggs = [
        (weighted_mean(m, weight) if use_weights and metric_kind(m, kinds) == "rate" else F.avg(m)).alias(m)
        for m in metrics
    ]
    # Rows are unique per (entity, period) and per (group, entity), so counting rows counts members.
    members = F.count(F.lit(1)).alias("member_count")
    grouped = (
        df.select(entity, period, *dict.fromkeys([*metrics, *([weight] if use_weights else [])]))
        .join(bridge, entity)
        .groupBy("group_key", "display_order", "use_normalized", period)
        .agg(*aggs, members)
    )
    norm, std = F.col("use_normalized"), ~F.col("use_normalized")
    out = []
    for m in metrics:
        c = F.col(m)
        if blank_regime and m.startswith("Norm_"):
            c = F.when(norm, c)
        elif blank_regime and m in STANDARD_RATES:
            c = F.when(std, c)
        out.append(c.alias(m))
    return grouped.select(
        (F.lit(id_base) + F.col("display_order")).cast("long").alias(entity),
        period,
        F.concat(F.lit("AVG: "), F.col("group_key")).alias("NAME"),
        "group_key",
        "member_count",
        *out,
    )


def combined_entity(
    df: DataFrame,
    members: Sequence[int],
    new_id: int,
    metrics: Sequence[str],
    weight: str,
    kinds: Mapping[str, str] | None = None,
    entity: str = ENTITY,
    period: str = PERIOD,
) -> DataFrame:
    """Merge of the given entities for the periods where all report: levels add up, rates are weighted."""
    aggs = [
        (weighted_mean(m, weight) if metric_kind(m, kinds) == "rate" else F.sum(F.coalesce(m, F.lit(0.0)))).alias(m)
        for m in present(df.columns, metrics)
    ]
    merged = (
        df.filter(F.col(entity).isin(list(members)))
        .groupBy(period)
        .agg(*aggs, F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == len(set(members)))
    )
    return merged.select(F.lit(new_id).cast("long").alias(entity), period, *[a for a in present(df.columns, metrics)])


def with_composites(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Panel and synthetic rows in one frame, told apart by ``is_composite``; columns only one side has are NULL on the other."""
    mark = lambda rows, value: rows.withColumn("is_composite", F.lit(value))
    return mark(df, False).unionByName(mark(extra, True), allowMissingColumns=True)


def member_audit(df: DataFrame, bridge: DataFrame, minimum: int = 2, entity: str = ENTITY) -> DataFrame:
    """Per group: configured members, members with data, and whether that is enough."""
    seen = df.select(entity).distinct().withColumn("_seen", F.lit(True))
    return (
        bridge.join(seen, entity, "left")
        .groupBy("group_key")
        .agg(F.count(F.lit(1)).alias("configured"), F.count("_seen").alias("found"))
        .withColumn("enough_members", F.col("found") >= minimum)
    )


def all_members(bridge: DataFrame, entity: str = ENTITY) -> DataFrame:
    """Every entity named by any group, once."""
    return bridge.select(entity).distinct()


def coverage_audit(
    df: DataFrame,
    bridge: DataFrame,
    metrics: Sequence[str],
    minimum: float = 0.5,
    entity: str = ENTITY,
    period: str = PERIOD,
) -> DataFrame:
    """Contributors per (group, period, metric) against configured members, for every period in the panel.

    Periods are calendar quarters, so their distinct list is short whatever the panel's size.
    """
    metrics = present(df.columns, metrics)
    sizes = bridge.groupBy("group_key").agg(F.count(F.lit(1)).alias("total_constituents"))
    periods = df.agg(F.array_sort(F.collect_set(period))).scalar()
    grid = sizes.withColumn(period, F.explode(periods))
    counts = (
        df.select(entity, period, *metrics)
        .join(bridge.select("group_key", entity), entity)
        .groupBy("group_key", period)
        .agg(*[F.count(m).alias(m) for m in metrics])
    )
    long = grid.join(counts, ["group_key", period], "left").unpivot(
        ["group_key", period, "total_constituents"], metrics, "metric_code", "contributor_count"
    )
    share = F.try_divide(F.coalesce("contributor_count", F.lit(0)), F.col("total_constituents"))
    return long.select(
        "group_key",
        period,
        "metric_code",
        F.coalesce("contributor_count", F.lit(0)).alias("contributor_count"),
        "total_constituents",
        share.alias("contributor_pct"),
        F.when(share < minimum, "LOW_COVERAGE").otherwise("OK").alias("coverage_flag"),
    )


def blank_low_coverage(
    composite_rows: DataFrame, audit: DataFrame, metrics: Iterable[str], period: str = PERIOD
) -> DataFrame:
    """NULL the composite metrics whose contributors were too few. Runs before any comparison."""
    metrics = present(composite_rows.columns, metrics)
    low = audit.groupBy("group_key", period).agg(
        *[F.bool_or((F.col("metric_code") == m) & (F.col("coverage_flag") == "LOW_COVERAGE")).alias(f"_low_{m}") for m in metrics]
    )
    joined = composite_rows.join(low, ["group_key", period], "left")
    return joined.withColumns(
        {m: F.when(~F.coalesce(F.col(f"_low_{m}"), F.lit(False)), F.col(m)) for m in metrics}
    ).drop(*[f"_low_{m}" for m in metrics])


def peer_sets(entities: DataFrame, subject: int, excluded: Sequence[int], entity: str = ENTITY) -> DataFrame:
    """Two memberships: all peers, and all peers without an exclusion list."""
    peers = entities.select(entity).distinct().filter(F.col(entity) != subject)
    both = F.array(F.lit("ALL_PEERS"), F.when(~F.col(entity).isin(list(excluded)), F.lit("PEERS_EX")))
    return peers.select(F.explode(F.array_compact(both)).alias("group_key"), entity).withColumns(
        {
            "display_order": F.when(F.col("group_key") == "ALL_PEERS", 1).otherwise(2),
            "use_normalized": F.lit(False),
        }
    )
