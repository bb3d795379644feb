"""A join with a table of one row a key, where a few keys may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1024  # keys with at least one in so many rows are joined by broadcast: there can be no more than SHARE of them


def join_by_weight(rows: DataFrame, side: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` with the columns of ``side`` but for ``weight``; keys are equal also where both are null.

    ``side`` has one row for every ``key`` of ``rows``, and ``weight`` is how many rows have it. Heavy keys go by broadcast, all others by
    shuffle, where no key has more than one in ``SHARE`` of the rows. Both frames are read twice, so write them first.
    """
    total = side.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) * SHARE >= F.lit(total)
    other = side.withColumnRenamed(key, "_key")
    hot, rest = F.broadcast(other.where(heavy).drop(weight)), other.where(~heavy).drop(weight)
    same = F.col(key).eqNullSafe(F.col("_key"))
    light = rows.join(F.broadcast(other.where(heavy).select("_key")), same, "left_anti")
    return rows.join(hot, same).drop("_key").unionByName(light.join(rest, same).drop("_key"))
