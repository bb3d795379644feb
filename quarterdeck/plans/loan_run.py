"""The loan-tagging run: extract and three lookups in, flagged loans out, as one lazy plan or written with its audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from quarterdeck.operators import tagging
from quarterdeck.sources import sinks


def prepare(extract: DataFrame) -> DataFrame:
    return tagging.expand_new_commitment(tagging.with_buckets(tagging.clean_extract(extract)))


def tag_loans(extract: DataFrame, credit: DataFrame, reserve: DataFrame, properties: DataFrame) -> DataFrame:
    return tagging.apply_flags(tagging.with_tags(prepare(extract), credit, reserve, properties))


def write_tagged(extract: DataFrame, credit: DataFrame, reserve: DataFrame, properties: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """Write the flagged loans and return the join rates, counted while they were written: the loans are read once for both."""
    tagged = tagging.apply_flags(tagging.with_tags(prepare(extract), credit, reserve, properties, audit=True))
    seen = Observation("join rates")
    sinks.write_extract(tagged.observe(seen, *tagging.join_rate_metrics()).drop(*tagging.KNOWN.values()), path, fmt)
    counts = seen.get
    names = [f"{kind}_{n}" for kind in ("total", "matched") for n in tagging.LOOKUPS]
    one = extract.sparkSession.createDataFrame([tuple(int(counts.get(n) or 0) for n in names)], ", ".join(f"{n} long" for n in names))
    return tagging.rate_rows(one)
