"""Exact quantiles of any number of columns, by counted ranges; no group is gathered in one task.

One path for groups of every size, in aggregates that combine on the map side:

1. a sketch of every column brackets the rank (:func:`sketch`; it can share an aggregate with other statistics);
2. exact counts under and up to the bracket tell whether the rank lies inside; a side where it does not goes out to the column's end;
3. only the values in the bracket are listed, equal ones once. They are counted in ``CELLS`` ranges of value, a running sum over the
   ranges of a group finds those that hold the rank, and only their values are ordered.

Ranks are counted on all rows, so the result does not depend on how good the sketch was, only the number of values listed does.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

ACCURACY = 10000
CELLS = 1024


def bracket(prob: float, accuracy: int = ACCURACY) -> tuple[float, float]:
    """The shares between which the sketch is asked for the rank."""
    margin = 10.0 / accuracy
    return max(0.0, prob - margin), min(1.0, prob + margin)


def sketch(values: Sequence[str], prob: float = 0.5, accuracy: int = ACCURACY, extra: Sequence[str] | None = None) -> Column:
    """The aggregate ``_sketch`` from which :func:`select_ranks` goes on: per column its count, ends and a bracket of the rank.

    ``extra`` has an aggregate (SQL text, of a struct, say) for each column, which comes along to the result.
    """
    low, high = bracket(prob, accuracy)
    part = "named_struct('n', count({v}), 'min', min({v}), 'max', max({v}), 'lo', {q}[0], 'hi', {q}[1]{more})"
    parts = [
        part.format(v=v, q=f"percentile_approx({v}, array({low}D, {high}D), {accuracy})", more="" if extra is None else f", 'extra', {extra[i]}")
        for i, v in enumerate(values)
    ]
    return F.expr(f"array({', '.join(parts)})").alias("_sketch")


def _with(rows: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with its group's row of ``side``. NULL is a key like any other; AQE broadcasts the side where it is small."""
    if not keys:
        return rows.crossJoin(F.broadcast(side))  # one row
    other = side.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in side.columns if c not in keys])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return rows.join(other, match).drop(*[f"_k_{k}" for k in keys])


def select_ranks(rows: DataFrame, sketched: DataFrame, keys: Sequence[str], values: Sequence[str], prob: float = 0.5) -> DataFrame:
    """``keys, _i, value, n`` (and ``extra``): the interpolated quantile of the column at place ``_i``, for columns with any value.

    ``sketched`` has one row per key with ``_sketch``. ``rows`` is read twice.
    """
    keys = list(keys)
    extra = "extra" in sketched.schema["_sketch"].dataType.elementType.names
    rows, bounds = rows.select(*keys, *values), sketched.select(*keys, "_sketch")
    counted = [F.expr(f"array({', '.join(f'count_if({v} {test.format(i)})' for i, v in enumerate(values))})") for test in ("< _sketch[{0}].lo", "<= _sketch[{0}].hi")]
    counts = _with(rows, bounds, keys).groupBy(*keys).agg(F.first("_sketch").alias("s"), counted[0].alias("u"), counted[1].alias("t"))
    first, last = "cast(floor({p}D * (z.s.n - 1)) as bigint)".format(p=prob), "cast(ceil({p}D * (z.s.n - 1)) as bigint)".format(p=prob)
    chosen = f"""transform(arrays_zip(s, u, t), z -> named_struct('n', z.s.n, 'first', {first}, 'last', {last},
        'share', {prob}D * (z.s.n - 1) - {first}, 'low', if({first} < z.u, z.s.min, z.s.lo), 'high', if({last} >= z.t, z.s.max, z.s.hi),
        'under', if({first} < z.u, 0L, z.u){", 'extra', z.s.extra" if extra else ""}))"""
    ranges = counts.select(*keys, F.expr(chosen).alias("_range"))
    listed = [f"if({v} between _range[{i}].low and _range[{i}].high, named_struct('i', {i}, 'x', {v}, 'range', _range[{i}]), null)" for i, v in enumerate(values)]
    near = _with(rows, ranges, keys).select(*keys, F.expr(f"explode(array_compact(array({', '.join(listed)})))").alias("_e"))
    near = near.groupBy(*keys, F.col("_e.i").alias("_i"), F.col("_e.x").alias("_x"), F.col("_e.range").alias("_range")).agg(F.count(F.lit(1)).alias("_c"))
    low, width = F.col("_range.low"), F.col("_range.high") - F.col("_range.low")
    cell = F.least(F.floor((F.col("_x") - low) / width * CELLS), F.lit(CELLS - 1))
    near = near.withColumn("_cell", F.when(F.isnan("_x"), CELLS - 1).when((width > 0) & (width < float("inf")), cell).otherwise(0))
    group = [*keys, "_i"]
    sizes = near.groupBy(*group, "_range", "_cell").agg(F.sum("_c").alias("_size"))
    upto = F.sum("_size").over(W.partitionBy(*group).orderBy("_cell").rowsBetween(W.unboundedPreceding, 0))
    sizes = sizes.withColumn("_end", F.col("_range.under") + upto)
    held = (F.col("_end") > F.col("_range.first")) & (F.col("_end") - F.col("_size") <= F.col("_range.last"))
    wanted = sizes.filter(held).select(*group, "_cell", (F.col("_end") - F.col("_size")).alias("_before"))
    picked = _with(near, wanted, [*group, "_cell"])
    inside_cell = W.partitionBy(*group, "_cell").orderBy("_x").rowsBetween(W.unboundedPreceding, 0)
    ranked = picked.withColumn("_cum", F.col("_before") + F.sum("_c").over(inside_cell))
    ends = ranked.groupBy(*group).agg(
        F.first("_range").alias("_range"),
        F.min(F.when(F.col("_cum") > F.col("_range.first"), F.col("_x"))).alias("_v0"),
        F.min(F.when(F.col("_cum") > F.col("_range.last"), F.col("_x"))).alias("_v1"),
    )
    between = F.when(F.col("_v0") == F.col("_v1"), F.col("_v0")).otherwise(F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_range.share"))
    return ends.select(*group, between.alias("value"), F.col("_range.n").alias("n"), *(["_range.extra"] if extra else []))


def _quantiles(df: DataFrame, keys: Sequence[str], values: Sequence[str], prob: float, accuracy: int) -> DataFrame:
    names = [f"_x{i}" for i in range(len(values))]
    rows = df.select(*keys, *[F.col(v).cast("double").alias(x) for v, x in zip(values, names)])
    return select_ranks(rows, rows.groupBy(*keys).agg(sketch(names, prob, accuracy)), keys, names, prob)


def exact_quantiles(df: DataFrame, keys: Sequence[str], values: Sequence[str], prob: float = 0.5, out: str = "median", accuracy: int = ACCURACY) -> DataFrame:
    """Interpolated quantile of every column of ``values`` per key: ``keys, metric, out, n``; no row for a column without values."""
    metric = F.array(*[F.lit(v) for v in values])[F.col("_i")]
    return _quantiles(df, keys, values, prob, accuracy).select(*keys, metric.alias("metric"), F.col("value").alias(out), "n")


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, prob: float = 0.5, out: str = "median", accuracy: int = ACCURACY) -> DataFrame:
    """Interpolated quantile of one column per key: ``keys, out, n``."""
    return _quantiles(df, keys, [value], prob, accuracy).select(*keys, F.col("value").alias(out), "n")
