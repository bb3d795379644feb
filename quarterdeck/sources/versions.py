"""A table by period whose periods are replaced as a whole: a reader sees the old rows of a period or the new ones, never part of either.

``rows/version=N/<period>=...`` holds what one commit wrote. It counts only once ``log/N`` is there, which lists the commit's periods and is put in
place by one rename. The rows of a period are those of the highest version whose log names it. A writer that dies before the
rename leaves files that nothing points to, and the commit can be made again; a writer that dies after it finds its own mark in the log.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarterdeck.operators.flows import PERIOD
from quarterdeck.session import scratch_path
from quarterdeck.sources.sinks import by_period

def _place(spark: SparkSession, path: str):
    """A path and the file system it lies in, whatever that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def committed(spark: SparkSession, root: str, period: str = PERIOD) -> DataFrame:
    """``version, mark, period``: the periods of every commit, a row at least for each commit."""
    schema = f"version long, mark string, `{period}` date"
    files, log = _place(spark, f"{root}/log")
    return spark.read.schema(schema).parquet(f"{root}/log/*") if files.exists(log) else spark.createDataFrame([], schema)


def latest_versions(spark: SparkSession, root: str, period: str = PERIOD) -> DataFrame:
    """``period, version``: which version holds the rows of each period. As many rows as there are periods."""
    return committed(spark, root, period).filter(F.col(period).isNotNull()).groupBy(period).agg(F.max("version").alias("version"))


def read(spark: SparkSession, root: str, schema, period: str = PERIOD) -> DataFrame:
    """The current rows, with the columns of ``schema``. Only the folders the log points to are read."""
    pointers = latest_versions(spark, root, period).collect()  # a row for each period
    if not pointers:
        return spark.createDataFrame([], schema)
    parts = [f"{root}/rows/version={r['version']}/{period}={r[period]}" for r in pointers]
    return spark.read.schema(schema).option("basePath", f"{root}/rows").parquet(*parts).select(*[f.name for f in schema])


def commit(spark: SparkSession, root: str, rows: DataFrame, periods: DataFrame, mark: str, period: str = PERIOD) -> bool:
    """Make ``rows`` the rows of all ``periods`` (others stay as they are); False where ``mark`` is committed already.

    One writer at a time, as a stream is. ``rows`` may read from the table itself: nothing it reads is replaced.
    """
    done = committed(spark, root, period)
    if not done.filter(F.col("mark") == mark).isEmpty():
        return False
    version = (done.agg(F.max("version")).first()[0] or 0) + 1
    # what a writer that died has left under this number is not pointed to, and goes
    by_period(rows, period).write.mode("overwrite").partitionBy(period).parquet(f"{root}/rows/version={version}")
    listed = periods.select(F.lit(version).cast("long").alias("version"), F.lit(mark).alias("mark"), F.col(period).cast("date").alias(period)).distinct()
    nothing = spark.createDataFrame([(version, mark, None)], listed.schema)
    point(spark, root, listed.unionByName(nothing), version)
    return True


def point(spark: SparkSession, root: str, listed: DataFrame, version: int) -> None:
    """Put a commit's log in place."""
    staged = f"{root}/staged-{version}-{scratch_path(spark, 'log').rsplit('-', 1)[1]}"
    listed.coalesce(1).write.parquet(staged)
    files, log = _place(spark, f"{root}/log")
    files.mkdirs(log)
    if not files.rename(_place(spark, staged)[1], _place(spark, f"{root}/log/{version}")[1]):
        raise RuntimeError(f"version {version} of {root} could not be put in place")


def replaced(spark: SparkSession, root: str, period: str = PERIOD) -> DataFrame:
    """``version, period`` that no reader looks at any more: what a clean-up may take away once no reader is at work."""
    every = committed(spark, root, period).select("version", period).filter(F.col(period).isNotNull()).distinct()
    return every.join(latest_versions(spark, root, period), ["version", period], "left_anti")


def columns(schema, names: Sequence[str]):
    """A schema with double columns added for the ``names`` it lacks."""
    out = type(schema)(list(schema.fields))
    for n in names:
        if n not in out.names:
            out.add(n, "double")
    return out
