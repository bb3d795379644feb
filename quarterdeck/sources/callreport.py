"""Quarterly call-report files: the cache by quarter, schedules merged per id, the id crosswalk."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quarterdeck.functions.names import find_column, normalize_names
from quarterdeck.sources.delimited import read_extract


def cache_schema(fields: Sequence[str]) -> T.StructType:
    """Superset schema of the cache: the column set changes over the years."""
    head = [T.StructField("CERT", T.LongType())]
    return T.StructType(head + [T.StructField(f, T.DoubleType()) for f in fields])


def read_quarter_cache(
    spark: SparkSession,
    root: str,
    fields: Sequence[str],
    ids: DataFrame | None = None,
    first: str | None = None,
    last: str | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """Rows of the per-quarter cache (folders ``REPDTE=yyyy-mm-dd``) with at least one target field.

    Period limits prune folders. ``ids`` is a frame of wanted ids, applied as a semi-join.
    """
    schema = cache_schema(fields).add("REPDTE", T.DateType())
    reader = spark.read.schema(schema)
    df = (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(root)
    if first:
        df = df.filter(F.col("REPDTE") >= F.to_date(F.lit(first)))
    if last:
        df = df.filter(F.col("REPDTE") <= F.to_date(F.lit(last)))
    df = df.filter(F.coalesce(*[F.col(f) for f in fields]).isNotNull())
    return df if ids is None else df.join(ids.select("CERT").distinct(), "CERT", "left_semi")


# Schedules read first; later files win.
SCHEDULE_ORDER = ["RI-C", "RC-C"]


def schedule_rank(name: str) -> int:
    """0 for the schedules that are read first, 1 for the rest."""
    return 0 if any(s in name.upper().replace("RIC", "RI-C").replace("RCC", "RC-C") for s in SCHEDULE_ORDER) else 1


def merge_schedules(long: DataFrame, codes: Sequence[str], key: str = "IDRSSD", rank: str = "file_rank") -> DataFrame:
    """One row per id from (id, code, value, file rank): per field the last file with a value wins. One aggregate, one shuffle."""
    last = lambda c: F.max(F.when(F.col("code") == c, F.struct(F.col(rank), F.col("value"))))["value"].alias(c)
    return long.filter(F.col("value").isNotNull() & F.col("code").isin(list(codes))).groupBy(key).agg(*[last(c) for c in codes])


def build_crosswalk(spark: SparkSession, path: str, ids: DataFrame | None = None, sep: str = "\t") -> DataFrame:
    """(IDRSSD, CERT) pairs of a reporter file, one per id, limited to wanted CERTs."""
    raw = normalize_names(read_extract(spark, path, sep=sep))
    rssd = find_column(raw.columns, "IDRSSD", ["RSSD_ID", "ID_RSSD"])
    cert = find_column(raw.columns, "FDIC_CERTIFICATE_NUMBER", ["CERT", "FDIC_CERT"])
    if rssd is None or cert is None:
        raise ValueError(f"no id columns among {raw.columns}")
    pairs = raw.select(F.col(rssd).try_cast("long").alias("IDRSSD"), F.col(cert).try_cast("long").alias("CERT"))
    pairs = pairs.filter(F.col("IDRSSD").isNotNull() & (F.col("CERT") > 0)).groupBy("IDRSSD").agg(F.min("CERT").alias("CERT"))
    wanted = pairs if ids is None else pairs.join(ids.select("CERT").distinct(), "CERT", "left_semi")
    return wanted.select("IDRSSD", "CERT")
