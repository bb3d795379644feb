"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every job here. Sizes are left to the cluster: AQE
# coalesces small shuffle partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot never compiles methods over 8000 bytes. Wide projections beyond that run faster as
    # split methods than as one whole-stage method that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(
    name: str = "quarterdeck", cores: int | str = "*", shuffle_partitions: int = 8, extra: Mapping[str, str] | None = None
) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or else a folder inside the session's warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return root.rstrip("/")


_WITHIN: ContextVar[str | None] = ContextVar("within", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside go at the end, also after an error. What is made of them must be written by then, elsewhere."""
    folder = scratch_path(spark, "temporary")
    before = _WITHIN.set(folder)
    try:
        yield
    finally:
        _WITHIN.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a frame once to the shared folder and go on from the files.

    For results that several branches of one plan read: the work behind them is done once, the
    lineage ends at files every executor can reach, and a lost executor costs a re-read only.
    Within ``temporary`` the files lie in its folder.
    """
    path, within = scratch_path(df.sparkSession, label), _WITHIN.get()
    if within:
        path = f"{within}/{path.rpartition('/')[2]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str = "table") -> DataFrame:
    """What ``make`` returns, written, and without the tables that it has materialized on the way."""
    path = scratch_path(spark, label)
    with temporary(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
