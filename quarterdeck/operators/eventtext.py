"""Dates, times and places out of listing text, with column functions only."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Patterns of a dated header and of a time range.
DATE_PATTERN = r"(\w+), (\w+) (\d+), (\d{4})"
TIME_PATTERN = r"(?i)(\d+:\d+)\s*([ap]m)(?:\s*[–-]\s*(\d+:\d+)\s*([ap]m))?"
DEFAULT_HOURS = 2


def dated_header(text: str) -> Column:
    """The first 'Weekday, Month d, yyyy' of a text, empty when there is none."""
    return F.regexp_extract(text, DATE_PATTERN, 0)


def header_date(header: str) -> Column:
    """Date of a header; NULL when it is no date."""
    part = lambda i: F.regexp_extract(header, DATE_PATTERN, i)
    return F.try_to_timestamp(F.concat_ws(" ", part(2), part(3), part(4)), F.lit("MMMM d yyyy")).cast("date")


def _clock(date: str, times: str, time_group: int, half_group: int) -> Column:
    t = F.regexp_extract(times, TIME_PATTERN, time_group)
    half = F.upper(F.regexp_extract(times, TIME_PATTERN, half_group))
    stamp = F.concat_ws(" ", F.date_format(date, "yyyy-MM-dd"), t, half)
    return F.when(t != "", F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd h:mm a")))


def extract_events(df: DataFrame, text: str) -> DataFrame:
    """Add event_date, starts_at and ends_at; a missing end is two hours after the start.

    A whole text is searched once for the header and, when that is a date, once for the times;
    the groups are then taken from those short matches.
    """
    dated = df.withColumn("_header", dated_header(text)).withColumn("event_date", header_date("_header"))
    plain = F.replace(F.col(text), F.lit("."), F.lit(""))
    times = F.when(F.col("event_date").isNotNull(), F.regexp_extract(plain, TIME_PATTERN, 0))
    timed = dated.withColumn("_times", times)
    timed = timed.withColumns(
        {"starts_at": _clock("event_date", "_times", 1, 2), "_end": _clock("event_date", "_times", 3, 4)}
    )
    default_end = F.col("starts_at") + F.expr(f"interval {DEFAULT_HOURS} hours")
    end = F.when(F.col("starts_at").isNotNull(), F.coalesce("_end", default_end))
    return timed.withColumn("ends_at", end).drop("_header", "_times", "_end")


def matches_place(place: str, terms: Sequence[str]) -> Column:
    """Does the place contain any of the terms, whatever the case? No terms match everything."""
    if not terms:
        return F.lit(True)
    low = F.lower(F.coalesce(F.col(place), F.lit("")))
    return reduce(lambda a, b: a | b, [low.contains(t.lower()) for t in terms])


def with_borough(place: str, boroughs: Mapping[str, str]) -> Column:
    """Append the borough of a known venue unless the text names it already."""
    out = F.col(place)
    for venue, borough in boroughs.items():
        known = F.lower(place).contains(venue.lower()) & ~F.lower(place).contains(borough.lower())
        out = F.when(known, F.concat(F.col(place), F.lit(f", {borough}"))).otherwise(out)
    return out
