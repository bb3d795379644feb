"""Filling gaps of one panel from a second source of the same rows."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from quarterdeck.functions.missing import present
from quarterdeck.operators.flows import ENTITY, PERIOD
from quarterdeck.session import materialize

# Columns that tell whether a quarter is filled, and whether a row got its source.
GATE_COLUMNS = ["RCFD1545", "RCFDJ466", "RCFDJJ04"]
STATUS_COLUMNS = ["RCFDJ466", "RCONJ466", "RCFDJJ04", "RCONJJ04"]


def quarters_to_patch(
    df: DataFrame, checks: Sequence[str] = GATE_COLUMNS, limit: float = 0.5, period: str = PERIOD
) -> DataFrame:
    """Periods where more than ``limit`` of the check cells are NULL or 0, with that share.

    Without any check column every period needs the patch.
    """
    cols = present(df.columns, checks)
    if not cols:
        return df.select(period).distinct().withColumn("missing_share", F.lit(1.0))
    empty = sum(F.when(F.coalesce(F.col(c), F.lit(0.0)) == 0, 1).otherwise(0) for c in cols)
    share = F.sum(empty) / (F.count(F.lit(1)) * F.lit(len(cols)))
    return df.groupBy(period).agg(share.alias("missing_share")).filter(F.col("missing_share") > limit)


def healed(main: Column, patch: Column) -> Column:
    """A non-zero own value wins, then a non-zero patch, then own zero, then whatever the patch has."""
    return F.coalesce(F.nullif(main, F.lit(0.0)), F.nullif(patch, F.lit(0.0)), main, patch)


def heal(
    df: DataFrame,
    patch: DataFrame,
    fields: Sequence[str] | None = None,
    entity: str = ENTITY,
    period: str = PERIOD,
    gate: DataFrame | None = None,
) -> DataFrame:
    """Left join the patch on (entity, period) and repair ``fields`` cell by cell.

    Both sides hold one row per key, so no key is hot. Patch-only rows are ignored and
    fields the main side lacks are added. ``gate`` limits the patch to some periods
    (see :func:`quarters_to_patch`); periods are few, so that semi-join broadcasts itself.
    """
    keys = [entity, period]
    fields = [c for c in (fields or patch.columns) if c not in keys and c in set(patch.columns)]
    fixes = patch.withColumn(period, F.col(period).cast("date"))
    if gate is not None:
        fixes = fixes.join(gate.select(period), period, "left_semi")
    fixes = fixes.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in fields])
    joined = df.withColumn(period, F.col(period).cast("date")).join(fixes, keys, "left")
    own = set(df.columns)
    out = {c: healed(F.col(c), F.col(f"_p_{c}")) if c in own else F.col(f"_p_{c}") for c in fields}
    return joined.withColumns(out).drop(*[f"_p_{c}" for c in fields])


def heal_status(df: DataFrame, checks: Sequence[str] = STATUS_COLUMNS, filled: Mapping[str, bool] | None = None) -> DataFrame:
    """Add the source flag (1/0) and SUCCESS / MISSING_DATA / NO_FIELDS.

    The flag looks at the first check column that holds any value. ``filled`` tells which do, where that is known
    (see :func:`heal_with_status`); else a scalar subquery looks.
    """
    cols = present(df.columns, checks)
    if not cols or (filled is not None and not any(filled.get(c) for c in cols)):
        return df.withColumns({"RIC_SOURCE_AVAILABLE": F.lit(0), "RIC_Source_Status": F.lit("NO_FIELDS")})
    if filled is not None:
        first = next(c for c in cols if filled.get(c))
        has = F.col(first).isNotNull()
        return df.withColumns({"RIC_SOURCE_AVAILABLE": has.cast("int"), "RIC_Source_Status": F.when(has, "SUCCESS").otherwise("MISSING_DATA")})
    # One scalar subquery for all check columns.
    known = df.agg(F.struct(*[(F.count(c) > 0).alias(c) for c in cols]).alias("filled")).scalar()
    chain = F.lit(0)
    for c in reversed(cols):
        chain = F.when(known[c], F.when(F.col(c).isNotNull(), 1).otherwise(0)).otherwise(chain)
    any_field = F.lit(False)
    for c in cols:
        any_field = any_field | known[c]
    status = F.when(~any_field, "NO_FIELDS").when(chain == 1, "SUCCESS").otherwise("MISSING_DATA")
    return df.withColumns({"RIC_SOURCE_AVAILABLE": chain, "RIC_Source_Status": status})


def heal_with_status(
    df: DataFrame, patch: DataFrame, fields: Sequence[str] | None = None, checks: Sequence[str] = STATUS_COLUMNS, gate: DataFrame | None = None
) -> DataFrame:
    """Heal and add the status with one run of the join: the check columns are counted while the healed rows are written.

    The rows come from the written table, so what reads them does not heal again.
    """
    rows = heal(df, patch, fields, gate=gate)
    cols = present(rows.columns, checks)
    if not cols:
        return heal_status(rows, checks)
    seen = Observation("healed")
    written = materialize(rows.observe(seen, *[F.count(c).alias(c) for c in cols]), "healed")
    counts = seen.get
    return heal_status(written, checks, {c: bool(counts.get(c)) for c in cols})


def attach_field(df: DataFrame, other: DataFrame, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """Left join of separately landed fields on (entity, period), both sides as dates."""
    other = other.withColumn(period, F.to_date(F.col(period).cast("string")))
    return df.withColumn(period, F.col(period).cast("date")).join(other, [entity, period], "left")


def operating_places(branches: DataFrame, entity: str = ENTITY, place: str = "STATE") -> DataFrame:
    """Sorted, comma-joined list of distinct places per entity.

    Distinct (entity, place) pairs come first, so the list that is finally gathered is
    bounded by the number of places, not of branches.
    """
    pairs = branches.select(entity, place).filter(F.col(place).isNotNull()).distinct()
    return pairs.groupBy(entity).agg(
        F.array_join(F.sort_array(F.collect_list(place)), ", ").alias("ALL_OPERATING_STATES")
    )


def attach_places(df: DataFrame, branches: DataFrame, entity: str = ENTITY, place: str = "STATE") -> DataFrame:
    return df.join(operating_places(branches, entity, place), entity, "left")


def attach_codes(df: DataFrame, crosswalk: DataFrame, code: str = "IDRSSD") -> DataFrame:
    """Translate an id through a one-to-one crosswalk; rows with an unknown id drop out."""
    return df.join(crosswalk, code, "inner")


def field_availability(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per field the share of non-NULL rows: empty (0), sparse (below 25 %), available."""
    have = present(df.columns, fields)
    absent = [c for c in fields if c not in set(have)]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in have])
    long = counts.unpivot(["_rows"], have, "field", "n") if have else None
    rows = long.select("field", F.try_divide(F.col("n") * F.lit(100.0), F.col("_rows")).alias("coverage_pct")) if have else None
    if absent:
        missing = counts.select(F.explode(F.array(*[F.lit(c) for c in absent])).alias("field"), F.lit(0.0).alias("coverage_pct"))
        rows = missing if rows is None else rows.unionByName(missing)
    pct = F.coalesce(F.col("coverage_pct"), F.lit(0.0))
    label = F.when(pct == 0, "empty").when(pct < 25, "sparse").otherwise("available")
    return rows.select("field", pct.alias("coverage_pct"), label.alias("availability"))
