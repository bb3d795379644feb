"""Second moments of any number of columns in one pass, and what follows from them: correlations and least squares.

A task turns its rows into sums per pair of columns by matrix products over Arrow batches; the sums of all tasks meet in one aggregate per
pair. The plan has the same size for three columns and for three hundred. Rows count for a pair where both columns have a value.
"""

from __future__ import annotations

from typing import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def centres(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """A point near the middle of each column, from which sums of squares lose no digits: its mean, 0 where there is none."""
    names = list(dict.fromkeys(columns))
    row = df.agg(*[F.avg(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))).alias(f"c{i}") for i, c in enumerate(names)]).first()
    return {c: float(v) if (v := row[f"c{i}"]) is not None and np.isfinite(v) else 0.0 for i, c in enumerate(names)}


def pair_sums(df: DataFrame, left: Sequence[str], right: Sequence[str], shift: Mapping[str, float] | None = None) -> DataFrame:
    """``i, j`` (places in ``left`` and ``right``) with the number of rows that have both, and the sums of x, y, xx, yy and xy over them.

    x and y are the columns less their ``shift`` (0 without one). NULL and NaN are no values. A pair without rows has no row.
    """
    names = list(dict.fromkeys([*left, *right]))
    at = {c: k for k, c in enumerate(names)}
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(names)])
    away = np.array([(shift or {}).get(c, 0.0) for c in names])
    a, b = [at[c] for c in left], [at[c] for c in right]

    def summed(batches):
        total = np.zeros((len(SUMS), len(a), len(b)))
        for batch in batches:
            x = np.stack([batch[k].to_numpy(zero_copy_only=False).astype(np.float64) for k in range(len(names))], axis=1) - away
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            mask = known.astype(np.float64)
            xa, xb, ma, mb = x[:, a], x[:, b], mask[:, a], mask[:, b]
            for k, (u, v) in enumerate(((ma, mb), (xa, mb), (ma, xb), (xa * xa, mb), (ma, xb * xb), (xa, xb))):
                total[k] += u.T @ v
        i, j = np.nonzero(total[0])
        if len(i):
            columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(t[i, j]) for t in total]]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *SUMS])

    parts = rows.mapInArrow(summed, "i int, j int, " + ", ".join(f"{s} double" for s in SUMS))
    return parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])


def pearson() -> Column:
    """The correlation of a row of :func:`pair_sums`; NULL where a column does not vary or there are fewer than two rows."""
    n = F.col("n")
    xx, yy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    r = F.try_divide(F.col("sxy") - F.col("sx") * F.col("sy") / n, F.sqrt(F.greatest(xx, F.lit(0.0))) * F.sqrt(F.greatest(yy, F.lit(0.0))))
    # sums about the mean of a column that does not vary are rounding only
    varies = (xx > F.col("sxx") * 1e-12) & (yy > F.col("syy") * 1e-12)
    return F.when((n > 1) & varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def correlation_pairs(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """``a, b, correlation`` of every column of ``left`` with every column of ``right``."""
    sums = pair_sums(df, left, right, centres(df, [*left, *right]))
    name = lambda names, c: F.array(*[F.lit(n) for n in names])[F.col(c)]
    return sums.select(name(left, "i").alias("a"), name(right, "j").alias("b"), "i", "j", pearson().alias("correlation"))


def least_squares(df: DataFrame, features: Sequence[str], target: str) -> dict[str, float]:
    """Coefficients of the least-squares fit without intercept, from the normal equations of the rows that have every value.

    The matrix has the features squared many cells, whatever the number of rows. Where features depend on each other, the shortest of
    the best solutions; without rows all 0.
    """
    names = [*features, target]
    size = len(features)
    gram = np.zeros((size + 1, size + 1))
    for r in pair_sums(df.dropna(subset=names), names, names).collect():  # a row for each pair of columns
        gram[r["i"], r["j"]] = r["sxy"]
    scale = np.sqrt(np.where(np.diag(gram)[:size] > 0, np.diag(gram)[:size], 1.0))
    found = np.linalg.lstsq(gram[:size, :size] / np.outer(scale, scale), gram[:size, size] / scale, rcond=1e-13)[0] / scale
    return {c: float(v) for c, v in zip(features, found)}


def linear(coefficients: Mapping[str, float]) -> Column:
    """The prediction of a fit as a column."""
    return sum((F.col(f"`{c}`") * F.lit(v) for c, v in coefficients.items()), F.lit(0.0))


def errors(predictions: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """RMSE, MSE and MAE in one row; NULL without rows."""
    gap = F.col(target) - F.col(prediction)
    mse = F.avg(gap * gap)
    return predictions.agg(F.sqrt(mse).alias("rmse"), mse.alias("mse"), F.avg(F.abs(gap)).alias("mae"))
