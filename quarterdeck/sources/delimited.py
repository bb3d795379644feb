"""Delimited files: string extracts with title rows, typed loads, tab-separated schedules."""

from __future__ import annotations

import csv
from typing import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quarterdeck.sources import lines


def head_record(spark: SparkSession, path: str, skip_rows: int, sep: str, quoted: bool = True) -> tuple[list[str], int]:
    """The cells of the first record with text after ``skip_rows`` records, and the number of the line after it.

    Read from the start of the first file, whose splits are in order; only as many lines as that takes reach the driver.
    """
    files = sorted(spark.read.text(path, recursiveFileLookup=True).inputFiles())
    if not files:
        return [], 0
    first = spark.read.text(unquote(files[0]))
    wanted = skip_rows + 20
    while True:
        start = [r[0] for r in first.limit(wanted).collect()]
        reader = csv.reader((line + "\n" for line in start), delimiter=sep, quoting=csv.QUOTE_MINIMAL if quoted else csv.QUOTE_NONE)
        for k, cells in enumerate(reader):
            known = reader.line_num < len(start) or len(start) < wanted  # else the record may go on
            if known and k >= skip_rows and any(c.strip() for c in cells):
                return cells, reader.line_num
        if len(start) < wanted:
            return [], len(start)
        wanted *= 4


def column_names(cells: Sequence[str]) -> list[str]:
    """Header cells as column names: trimmed, numbered where empty, told apart where they come again."""
    out: list[str] = []
    for k, cell in enumerate(cells):
        name = base = cell.strip().lstrip("\ufeff") or f"_c{k}"
        again = 0
        while name.lower() in {n.lower() for n in out}:
            again += 1
            name = f"{base}.{again}"
        out.append(name)
    return out


def read_extract(spark: SparkSession, path: str, skip_rows: int = 0, sep: str = ",", line_breaks: bool = True) -> DataFrame:
    """A delimited extract with a header, every column a string. ``skip_rows`` title records before the header are skipped.

    ``path`` is a file, or a folder of files that each begin with the same titles and header. Lines are known by their number, so a body
    row that is equal to a title or the header stays. Cells may hold line breaks; where they do not, ``line_breaks=False`` spares
    the pass that looks for them, and without titles the reader of the format is used. Blank lines are left out. An empty file has no columns.
    """
    if skip_rows == 0 and not line_breaks:
        return spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    names, start = head_record(spark, path, skip_rows, sep)
    records = lines.numbered_records(spark, path, sep) if line_breaks else lines.numbered_lines(spark, path)
    body = records.filter((F.col("line") >= start) & (F.trim("value") != ""))
    quoted = [n.replace("`", "``") for n in column_names(names)]
    if not quoted:
        return spark.createDataFrame([], T.StructType())
    parsed = F.from_csv("value", ", ".join(f"`{n}` string" for n in quoted), {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    return body.select(parsed.alias("r")).select("r.*")


# The columns a tagged extract is expected to have, and their types.
EXTRACT_TYPES = {
    "TL_FACILITY_DIGITS12": "string", "FACILITY_ID": "string", "ACCOUNT_NUMBER": "string", "KEY_ACCT": "string",
    "BORROWER": "string", "NAME": "string", "SUB_PRODUCT_NORM": "string", "PRODUCT_BUCKET": "string",
    "IS_LAL_NFP": "boolean", "FOCUS_LIST": "string", "TXT_MSTR_FACIL_COLLATERAL_DESC": "string", "SBL_PERC": "double",
    "BOOK_DATE": "date", "EFFECTIVE_DATE": "date", "ORIGINATION_DATE": "date", "BALANCE": "double",
    "CREDIT_LIMIT": "double", "AMT_ORIGINAL_COMT": "double", "CREDIT_LII": "double", "NEW_CAMP_YN": "string",
    "NEW_CAMP_REASON": "string", "BASE_COMMIT": "double", "LATEST_COMMIT": "double", "COMMIT_DELTA": "double",
    "NEW_COMMITMENT_AMOUNT": "double", "NEW_COMMITMENT_REASON": "string", "CREDIT_LII_COMMITMENT_BUCKET": "string",
    "CREDIT_LII_COMMITMENT_FLOOR": "bigint", "FLAGS": "string", "FLAG_COUNT": "bigint", "QUALIFIED": "boolean",
}


def apply_types(df: DataFrame, types: Mapping[str, str] = EXTRACT_TYPES) -> DataFrame:
    """Cast the expected columns that are there; unreadable cells become NULL, other columns stay text."""
    return df.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def read_typed(spark: SparkSession, path: str, types: Mapping[str, str] = EXTRACT_TYPES) -> DataFrame:
    return apply_types(read_extract(spark, path), types)


# Names of the two key columns of a schedule.
SCHEDULE_KEYS = {
    "IDRSSD": ("IDRSSD", "ID_RSSD", "RSSD", "RSSDID", "RSSD_ID"),
    "CERT": ("CERT", "FDIC_CERT", "FDIC CERTIFICATE NUMBER", "FDICCERT", "FDIC_CERTIFICATE_NUMBER", "FDICERT"),
}


def parse_schedule(spark: SparkSession, path: str, keys: Mapping[str, Sequence[str]] = SCHEDULE_KEYS) -> DataFrame:
    """A tab-separated schedule as (key, code, value); the key column is the first that is one of ``keys``.

    Line 0 holds the codes, line 1 their descriptions; both are known by their number. Quotes and thousands commas are
    dropped; cells that are no numbers are NULL and left out. A file without a key column has no rows. ``path`` may be a folder of files
    with the same codes.
    """
    head, _ = head_record(spark, path, 0, "\t", quoted=False)
    codes = [c.strip().strip('"').strip().upper() for c in head]
    kind, at = next(((kind, i) for i, c in enumerate(codes) for kind, names in keys.items() if c in names), (next(iter(keys)), None))
    if at is None:
        return spark.createDataFrame([], f"{kind} long, code string, value double")
    cells = F.transform(F.split("value", "\t"), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    rows = lines.numbered_lines(spark, path).filter((F.col("line") >= 2) & (F.trim("value") != "")).select(cells.alias("cells"))
    key = F.try_element_at("cells", F.lit(at + 1)).try_cast("long").alias(kind)
    number = lambda i: F.regexp_replace(F.try_element_at("cells", F.lit(i + 1)), ",", "").try_cast("double")
    pairs = F.array(*[F.struct(F.lit(c).alias("code"), number(i).alias("value")) for i, c in enumerate(codes) if i != at and c])
    return rows.select(key, F.explode(pairs).alias("p")).select(kind, "p.code", "p.value").filter(
        F.col(kind).isNotNull() & F.col("value").isNotNull()
    )
