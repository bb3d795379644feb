"""Writers: the tagged extract and the named result tables."""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

REQUIRED_TAGS = ["IS_NTC", "IS_OFFICE", "HAS_CREDIT_POLICY_EXCEPTION", "FLAGS", "FLAG_COUNT", "QUALIFIED"]
# The panel is read by period, so it is stored by period.
PARTITIONS = {"panel": ["REPDTE"]}


def by_period(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one period together, so that not every task writes every period.

    A rebalance, not a repartition: AQE splits a period that is too large for one task.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_extract(df: DataFrame, path: str, fmt: str = "csv", required: Sequence[str] = tuple(REQUIRED_TAGS)) -> None:
    """Write the tagged loans; refuses a frame that lacks a required column."""
    missing = [c for c in required if c not in set(df.columns)]
    if missing:
        raise ValueError(f"tagged extract lacks {missing}")
    flat = df.drop(*[c for c, t in df.dtypes if t.startswith("array")])
    writer = flat.write.mode("errorifexists")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def latest_partition(spark: SparkSession, path: str, period: str = "REPDTE") -> DataFrame:
    """Rows of the last period with any, of a table laid out by period.

    The periods are read from the folders' names, so only the last folder is opened (and the one before it where that one
    has no row).
    """
    table = spark.read.parquet(path)
    found = {m[1] for f in table.inputFiles() if (m := re.search(rf"/{re.escape(period)}=(\d{{4}}-\d\d-\d\d)/", f))}
    for day in sorted(found, reverse=True):
        rows = table.filter(F.col(period) == F.to_date(F.lit(day)))
        if not rows.isEmpty():
            return rows
    return table.filter(F.lit(False))


def write_tables(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """One Parquet table per result under ``root``; returns name -> path."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        by = [c for c in PARTITIONS.get(name, []) if c in set(df.columns)]
        (by_period(df, *by) if by else df).write.mode("errorifexists").partitionBy(*by).parquet(paths[name])
    return paths
