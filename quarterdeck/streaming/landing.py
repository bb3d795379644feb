"""Quarterly patch files arriving over time: each micro-batch heals the quarters it touches and puts them in place together."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarterdeck.operators.flows import ENTITY, PERIOD
from quarterdeck.operators.heal import heal
from quarterdeck.sources.callreport import cache_schema
from quarterdeck.sources import versions


def patch_stream(spark: SparkSession, landing: str, fields: Sequence[str]) -> DataFrame:
    """Patch rows from CSV files as they land."""
    schema = cache_schema(fields).add(PERIOD, "date")
    landed = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_name").alias("name"))
    return spark.readStream.schema(schema).option("header", True).csv(landing).select("*", landed.alias("_landed"))


def healed_panel(spark: SparkSession, panel_path: str, out_path: str, fields: Sequence[str]) -> DataFrame:
    """The panel as healed so far: committed quarters from ``out_path``, all others from the panel."""
    panel = spark.read.parquet(panel_path)
    schema = versions.columns(panel.schema, fields)
    fresh = panel.join(versions.latest_versions(spark, out_path).select(PERIOD), PERIOD, "left_anti")
    return fresh.unionByName(versions.read(spark, out_path, schema), allowMissingColumns=True)


def heal_batch(spark: SparkSession, batch: DataFrame, panel_path: str, out_path: str, fields: Sequence[str], mark: str) -> bool:
    """Heal the quarters a batch touches and commit them together under ``mark``; False where that is done already."""
    # of repeated rows the later file's value counts, the larger one within a file; a cell it leaves empty is no value
    last = lambda f: F.max(F.when(F.col(f).isNotNull(), F.struct("_landed", f))).getField(f).alias(f)
    patch = batch.groupBy(ENTITY, PERIOD).agg(*[last(f) for f in fields])
    quarters = patch.select(PERIOD).distinct()
    panel = healed_panel(spark, panel_path, out_path, fields)
    healed = heal(panel.join(quarters, PERIOD, "left_semi"), patch, fields)
    return versions.commit(spark, out_path, healed, healed.select(PERIOD).distinct(), mark)


def heal_stream(spark: SparkSession, landing: str, panel_path: str, out_path: str, checkpoint: str, fields: Sequence[str]):
    """Heal the quarters that landed files bring, a commit for each batch (see ``versions``); read with :func:`healed_panel`.

    A quarter that an earlier batch healed goes on from its healed rows, so a later file for it loses nothing. A batch that
    failed is made again as a whole, and one that was committed before its stream noted it is not made twice. The panel is pruned to the
    batch's quarters by a semi-join on the period.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        heal_batch(batch.sparkSession, batch, panel_path, out_path, fields, f"{checkpoint}#{epoch}")

    return (
        patch_stream(spark, landing, fields)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
