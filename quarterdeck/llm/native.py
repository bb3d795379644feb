"""Word arrays, hashes of word runs and numbered occurrences as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[ \t\n\x0B\f\r]+"


def word_array(text: Column) -> Column:
    """Words of a text: runs of characters other than space and 9 to 13; none for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def with_grams(df: DataFrame, words: str, n: int, out: str) -> DataFrame:
    """Hash of every ``n`` consecutive words; one hash of all words where there are fewer, none without words."""
    count = F.size(words)
    inner = F.transform(F.sequence(F.lit(0), F.greatest(count - n, F.lit(0))), lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(n)]))
    return df.withColumn(out, F.when(count > 0, inner).otherwise(F.array().cast("array<bigint>")))


def numbered(df: DataFrame, values: str, out: str, place_bits: int = 28) -> DataFrame:
    """``out``: each value hashed with the number of equal values before it, packed above its place in the array.

    The array is sorted once; equal values lie together there, and the lengths of their runs give the numbers. The upper
    ``64 - place_bits`` bits hold the hash, the lower bits the place.
    """
    mask = (1 << place_bits) - 1
    packed = F.transform(F.col(values), lambda h, i: F.shiftleft(h, place_bits).bitwiseOR(i.cast("long")))
    df = df.withColumn("_sorted", F.sort_array(packed))
    key = lambda e: F.shiftrightunsigned(e, place_bits)
    s, n = F.col("_sorted"), F.size("_sorted")
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i == 0) | (key(F.get(s, i)) != key(F.get(s, i - 1))))
    df = df.withColumn("_starts", F.concat(starts, F.array(n)))
    at = F.col("_starts")
    runs = F.transform(F.sequence(F.lit(1), F.size("_starts") - 1), lambda j: F.sequence(F.lit(0), F.get(at, j) - F.get(at, j - 1) - 1))
    df = df.withColumn("_numbers", F.when(n > 0, F.flatten(runs)).otherwise(F.array().cast("array<int>")))
    high = F.lit(-(mask + 1))
    done = F.zip_with("_sorted", "_numbers", lambda e, o: F.xxhash64(key(e), o).bitwiseAND(high).bitwiseOR(e.bitwiseAND(F.lit(mask))))
    return df.withColumn(out, done).drop("_sorted", "_starts", "_numbers")
