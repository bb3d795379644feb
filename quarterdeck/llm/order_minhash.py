"""Document fingerprints that feel edit distance: Order MinHash over words, in column expressions only.

The k-mers of a text are its runs of ``K`` words, numbered where they repeat. Their hashes lie on a ring with ``POINTS`` points at equal
distances; of each point the next ``2`` k-mers on the ring are selected, put back into text order, and hashed as a tuple. A point's value
changes when either k-mer goes or when their order turns. To each point the two are as likely any two of the text, as they are under a
hash function of its own, but points without a k-mer between them select the same two: a text of ``n`` k-mers has at most ``n`` selections, so the
likeness of short texts has the same mean as with separate functions and spreads more. The likeness of two fingerprints is the share of points whose values agree.

Words are runs of characters other than space and 9 to 13. Texts without words have the empty fingerprint (null texts too), and two such
fingerprints have likeness 1. Texts of fewer than ``K`` words have one k-mer, all their words;
a single k-mer has no order and is hashed alone.

The next document is the one with the next larger id; rows of one id follow each other by text, null ids come last, and the first row
follows the last. A table of one row is its own next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.native import numbered, with_grams, word_array

K = 2
POINT_BITS = 6
POINTS = 1 << POINT_BITS
PLACE_BITS = 28


def signed(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: an array with a number for each point, the point in the lowest bits; empty without words."""
    df = with_grams(df.withColumn("_words", word_array(F.col(text))), "_words", K, "_grams").drop("_words")
    df = numbered(df, "_grams", "_numbered", PLACE_BITS).withColumn("_ranked", F.sort_array("_numbered"))
    ranked, grams, n = F.col("_ranked"), F.col("_grams"), F.size("_ranked")
    # the last point at or before a hash, in the signed order that the array is in
    point = lambda e: (F.shiftright(e, 64 - POINT_BITS) + POINTS // 2).cast("int")
    place = lambda e: e.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    first = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i == 0) | (point(F.get(ranked, i)) != point(F.get(ranked, i - 1))))
    df = df.withColumn("_first", first)

    def value(i: Column) -> Column:
        at, to = place(F.get(ranked, i)), place(F.get(ranked, (i + 1) % n))
        alone = F.xxhash64(F.get(grams, at))
        pair = F.when(at < to, F.xxhash64(F.get(grams, at), F.get(grams, to))).otherwise(F.xxhash64(F.get(grams, to), F.get(grams, at)))
        return F.when(n > 1, pair).otherwise(alone)

    def points(i: Column) -> Column:
        """The value of a k-mer that is the next one of some points, once for each of them."""
        before = F.when(i > 0, point(F.get(ranked, i - 1))).otherwise(F.lit(-1))
        return F.array_repeat(value(i), point(F.get(ranked, i)) - before)

    df = df.withColumn("_values", F.flatten(F.transform("_first", points)))
    # the points after the last k-mer go on with the first one
    around = F.array_repeat(value(F.lit(0)), F.lit(POINTS) - F.size("_values"))
    numbers = F.transform(F.concat("_values", around), lambda e, j: F.shiftleft(e, POINT_BITS).bitwiseOR(j.cast("long")))
    done = F.when(n > 0, numbers).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, done).drop("_grams", "_numbered", "_ranked", "_first", "_values")


def fingerprint(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda e: F.hex(e)), " ")


def likeness(a: Column, b: Column) -> Column:
    either = F.greatest(F.size(a), F.size(b))  # every text with words has all points
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(either, F.lit(1)))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, own`` with ``next_text`` and ``next_own`` of the following document. ``text`` is not null; ``own`` is its signature.

    Rows are dealt to ranges of ids with about as many rows each, and every range is one window: one shuffle of the texts. Only the first
    text of each range - as many as there are ranges, whatever the table - is handed to the range before it, and signed again there.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 20 * ranges)).first()[0] or []
    bounds = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    number = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col("doc_id"))))
    ranged = docs.withColumn("_range", number)

    lowest = ranged.groupBy(F.col("_range").alias("_own")).agg(F.min("doc_id").alias("_id"))
    firsts = ranged.select("_range", "doc_id", "text").join(F.broadcast(lowest), (F.col("_range") == F.col("_own")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    firsts = signed(firsts.groupBy("_range").agg(F.min("text").alias("head_text")), "head_text", "head_own")
    numbers = lowest.select(F.col("_own").alias("_before"), F.lead("_own").over(Window.orderBy("_own")).alias("_after"))
    numbers = numbers.join(F.broadcast(lowest.agg(F.min("_own").alias("_least"))))
    heads = numbers.join(firsts, F.coalesce("_after", "_least") == F.col("_range")).select("_before", "head_text", "head_own")

    order = Window.partitionBy("_range").orderBy(F.col("doc_id").asc_nulls_last(), "text")
    rows = ranged.withColumn("_next", F.lead(F.struct("text", "own")).over(order))
    both = rows.join(heads.hint("merge"), (F.col("_range") == F.col("_before")) & F.col("_next").isNull(), "left")
    last = F.col("_next").isNull()
    return both.select(
        "doc_id", "text", "own", F.when(last, F.col("head_text")).otherwise(F.col("_next.text")).alias("next_text"), F.when(last, F.col("head_own")).otherwise(F.col("_next.own")).alias("next_own")
    )


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points, rounded down, replaced by as many of the next document's first ones."""
    own, other = F.coalesce(text, F.lit("")), F.coalesce(following, F.lit(""))
    half = F.floor(F.length(own) / 2).cast("int")
    return F.concat(F.substring(own, F.lit(1), F.length(own) - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, length, the edited text's hash, both fingerprints, likeness to the edited text's and the next document's."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    both = with_next(signed(own, "text", "own"))
    both = both.withColumn("edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    both = both.withColumn("n_chars", F.length("text").cast("long")).drop("text")
    both = signed(both.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)), "edited", "changed")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
