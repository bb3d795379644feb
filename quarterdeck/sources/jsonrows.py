"""Nested JSON payloads flattened to rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _list(text: Column) -> Column:
    """A JSON array as an array of JSON texts; NULL for anything else."""
    return F.when(text.startswith("["), F.from_json(text, "array<string>"))


def _fields(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` string" for n in dict.fromkeys(names))


def payload_rows(doc: Column, envelope: Column) -> Column:
    """Top-level rows of the accepted shapes: a list, ``data``, ``data.results``, ``results.rows`` or ``results``; else the document.

    ``envelope`` is the parsed document with its ``data`` and ``results`` as JSON texts.
    """
    inside = lambda text, name: _list(F.from_json(text, _fields([name]))[name])
    data, results = envelope["data"], envelope["results"]
    return F.coalesce(
        _list(F.trim(doc)), _list(data), inside(data, "results"), inside(results, "rows"), _list(results), F.array(doc)
    )


def flatten_results(df: DataFrame, json_col: str, fields: Sequence[str], keep: Sequence[str] = (), depth: int = 10) -> DataFrame:
    """Explode nested ``results`` lists; a field a child has overrides its parent's, also where the child's is null.

    The plan has a fixed number of passes (``depth``, at most 10). Nodes without the word ``results`` are parsed once, at
    the end; the others once per pass. Children that are no objects are skipped; an empty list leaves its row.
    """
    if not 1 <= depth <= 10:
        raise ValueError("depth must be between 1 and 10")
    doc = F.col(json_col)
    head = df.select(*keep, doc.alias("_doc"), F.from_json(doc, _fields([*fields, "data", "results"])).alias("_p"))
    # fields of the envelope itself are the outermost parents
    rows = head.select(
        *keep, *[F.col(f"_p.{f}").alias(f) for f in fields], F.explode(payload_rows(F.col("_doc"), F.col("_p"))).alias("_node")
    )
    # as a map, which tells a null field from one that is not there
    own = [F.when(F.coalesce(F.map_contains_key("_p", f), F.lit(False)), F.col("_p")[f]).otherwise(F.col(f)).alias(f) for f in fields]
    entries = lambda when: F.when(when, F.from_json("_node", "map<string,string>")).alias("_p")
    for _ in range(depth):
        parsed = rows.select(*keep, *fields, "_node", entries(F.col("_node").contains('"results"')))
        listed = parsed.select(*keep, *own, "_node", _list(F.col("_p")["results"]).alias("_inner"))
        children = F.filter("_inner", lambda c: c.startswith("{"))
        kids = F.when(F.coalesce(F.size("_inner"), F.lit(0)) > 0, children).otherwise(F.array("_node"))
        rows = listed.select(*keep, *fields, F.explode(kids).alias("_node"))
    last = rows.select(*keep, *fields, entries(F.lit(True)))
    return last.select(*keep, *own)
