"""Text files read in splits, with every line's number in its file and quoted line breaks joined.

A text scan numbers nothing, and a split does not know how many lines stand before it, or whether it begins inside a quoted cell. One
pass counts the lines of each split and finds what the split does to either state; running sums over the few rows that gives carry both
from split to split. A line's number is then its place in the split plus the lines before.

A line leaves the state as it is, turns it round, or fixes it whatever it was. So the state after any run of lines is that of the last line that
fixes it, turned round as often as lines after it do: two running sums and a last value, for lines in a split as for splits in a file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W, WindowSpec

from quarterdeck.session import materialize

SPLIT = ["_file", "_start"]


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``value`` with their file, the start of their split and ``_id``, which rises by one from line to line of a split."""
    lines = spark.read.text(path, recursiveFileLookup=True)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id")
    )


def _opens(value: Column, sep: str) -> Column:
    """Whether a line that begins outside a quoted cell ends inside one. Quotes count at the start of a cell only; two in one are a character."""
    edge = re.escape(sep)
    plain = f"[^{edge}]" if len(sep) == 1 else f"(?:(?!{edge})[\\s\\S])"
    # one match from end to end, without backtracking: a cell is quoted up to a closing quote, or does not begin with a quote
    cell = f'(?:"[^"]*+(?:""[^"]*+)*+"|(?!")){plain}*+'
    return ~value.rlike(f"\\A{cell}(?:{edge}{cell})*+\\z")


def with_effect(lines: DataFrame, sep: str) -> DataFrame:
    """``_turn`` (1 where a line turns the state round) and ``_fix`` (the state, 0 or 1 for inside, that it leaves whatever it was)."""
    closing = '^[^"]*+(?:""[^"]*+)*+"'
    from_out = _opens(F.col("value"), sep)
    from_in = F.when(~F.col("value").rlike(closing), True).otherwise(_opens(F.regexp_replace("value", closing, "x"), sep))
    quoted = F.instr("value", '"') > 0
    made = lines.withColumns({"_o": (quoted & from_out).cast("int"), "_i": (~quoted | from_in).cast("int")})
    turn, fix = ((F.col("_o") == 1) & (F.col("_i") == 0)).cast("int"), F.when(F.col("_o") == F.col("_i"), F.col("_o"))
    return made.withColumns({"_turn": turn, "_fix": fix}).drop("_i")


def with_state(rows: DataFrame, w: WindowSpec) -> DataFrame:
    """What the rows up to each one do to the state: ``_fixed``, the state after them whatever it was before, or else ``_odd`` turns."""
    turned = rows.withColumn("_turns", F.sum("_turn").over(w))
    fixes = F.last(F.when(F.col("_fix").isNotNull(), F.struct(F.col("_fix"), F.col("_turns"))), ignorenulls=True).over(w)
    made = turned.withColumn("_last", fixes)
    fixed = (F.col("_last")["_fix"] + F.col("_turns") - F.col("_last")["_turns"]) % 2
    return made.withColumns({"_fixed": fixed, "_odd": F.col("_turns") % 2}).drop("_last", "_turns")


def up_to_here(*keys: str, order: str) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)


def before(*keys: str, order: str) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)


def split_counts(lines: DataFrame, *more: Column) -> DataFrame:
    """Per split: its first ``_id`` and the lines before it in its file, and aggregates ``more``."""
    counted = lines.groupBy(*SPLIT).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), *more)
    return counted.withColumn("_before", F.coalesce(F.sum("_n").over(before("_file", order="_start")), F.lit(0))).drop("_n")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, line``: every line with its number in its file, from 0."""
    lines = raw_lines(spark, path)
    # one row a split, of some hundred megabytes: lines are not shuffled for it
    placed = lines.join(F.broadcast(split_counts(lines).select(*SPLIT, "_first", "_before")), SPLIT)
    return placed.select("value", F.col("_file").alias("file"), (F.col("_before") + F.col("_id") - F.col("_first")).alias("line"))


def numbered_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``value, file, line``: as :func:`numbered_lines`, with lines inside a quoted cell joined to the line the cell starts in.

    Files in which no line leaves a cell open are only counted. In others each split is ordered, and only lines of records that go over
    several lines are gathered, by record. Line ends inside a cell come back as line feeds. A quote that is never closed takes
    the rest of its file along.
    """
    lines = with_effect(raw_lines(spark, path), sep)
    counts = split_counts(lines, F.max("_o").alias("_opens"))
    counts = materialize(counts.withColumn("_open", F.max("_opens").over(W.partitionBy("_file")) == 1).drop("_opens"), "splits")
    placed = lines.join(counts, SPLIT).withColumn("line", F.col("_before") + F.col("_id") - F.col("_first"))
    whole = placed.filter(~F.col("_open")).select("value", F.col("_file").alias("file"), "line")
    if counts.filter("_open").isEmpty():
        return whole
    local = with_state(placed.filter("_open").select("value", *SPLIT, "line", "_o", "_turn", "_fix"), up_to_here(*SPLIT, order="line"))
    splits = local.groupBy(*SPLIT).agg(F.max(F.struct("line", "_fixed", "_odd")).alias("_end"))
    splits = splits.select(*SPLIT, F.col("_end._fixed").alias("_fix"), F.when(F.col("_end._fixed").isNull(), F.col("_end._odd")).otherwise(0).alias("_turn"))
    ends = with_state(splits, up_to_here("_file", order="_start"))
    begins = F.lag(F.coalesce("_fixed", "_odd")).over(W.partitionBy("_file").orderBy("_start"))
    known = local.join(ends.select(*SPLIT, F.coalesce(begins, F.lit(0)).alias("_begins")), SPLIT)
    after = F.coalesce("_fixed", (F.col("_begins") + F.col("_odd")) % 2)
    known = known.withColumn("_after", after).withColumn("_inside", F.coalesce(F.lag("_after").over(W.partitionBy(*SPLIT).orderBy("line")), "_begins") == 1)
    alone = known.filter(~F.col("_inside") & (F.col("_after") == 0)).select("value", F.col("_file").alias("file"), "line")
    # A record of several lines starts at a line that is outside and ends inside: numbering those numbers the records.
    parts = known.filter(F.col("_inside") | (F.col("_after") == 1)).withColumn("_new", (~F.col("_inside")).cast("int"))
    starts = parts.groupBy(*SPLIT).agg(F.sum("_new").alias("_s"))
    earlier = F.coalesce(F.sum("_s").over(before("_file", order="_start")), F.lit(0))
    here = F.sum("_new").over(up_to_here(*SPLIT, order="line"))
    record = parts.withColumn("_here", here).join(starts.withColumn("_earlier", earlier), SPLIT).withColumn("_record", F.col("_earlier") + F.col("_here"))
    cells = F.array_sort(F.collect_list(F.struct("line", "value")))
    joined = record.groupBy("_file", "_record").agg(cells.alias("c")).select(F.array_join("c.value", "\n").alias("value"), F.col("_file").alias("file"), F.col("c")[0]["line"].alias("line"))
    return whole.unionByName(alone).unionByName(joined)
