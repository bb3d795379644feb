"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set is its distinct word shingles; its sketch is the ``SKETCH`` smallest hashes of the set. Documents with equal sets are one
from the start. Inverted lists hold, for each document, only the rarest of its retained values: two documents that reach the threshold share
so many retained values that they share one of these. In sets smaller than a sketch that is always so. In larger ones every shared value of the
sketch of their union is in both sketches, whatever the sizes of the two, and these are at least binomial with the similarity as chance; ``shared_at_least``
is the most that they fall short of with a chance of no more than ``LOST`` (1e-8; 1.2e-9 for 13 of 32 at 0.85, 3.3e-9 for 11 of 32 at 0.8). Pairs on a
list are estimated from the sketch of their union, by the same count and so without further loss, and confirmed on the full sets. Components follow from links that lists and hubs give (see ``linking``); the documents of lists that stay mixed
after the hubs are listed anew by the rarest values of their full sets, where the place of a shared value bounds the overlap. That loses no link.

A-Z is lower-cased, words are runs of bytes other than space and 9 to 13. Documents with fewer words than a shingle have their whole
sequence as one. Null texts and texts without words have an empty set and are linked with nothing. A null id is no one's representative:
its row gets the component of its set, or null. Repeated rows share a set. Other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.hashing import shingles
from quarterdeck.llm.linking import crowded, link
from quarterdeck.session import materialize

SKETCH = 32
WORDS, SIMILARITY = 5, Fraction(4, 5)
LOST = 1e-8  # chance that two linked sets share fewer retained values than asked for


def _digest(found: np.ndarray) -> tuple[str | None, int]:
    """A set's key, and its first 64 bits as a number that tells sets of one id apart."""
    if not len(found):
        return None, 0
    raw = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return raw.hex(), int.from_bytes(raw[:8], "little", signed=True)


def _signatures(words: int, size: int):
    @F.pandas_udf("n long, set_key string, tie long, sketch array<long>")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            found = shingles(text, words).view(np.int64)
            out.append((len(found), *_digest(found), np.sort(np.partition(found, size)[:size] if len(found) > size else found)))
        return pd.DataFrame(out, columns=["n", "set_key", "tie", "sketch"])

    return run


def _sets(words: int):
    @F.pandas_udf("tie long, full array<long>")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(t, words).view(np.int64) for t in texts]
        return pd.DataFrame({"tie": [_digest(f)[1] for f in found], "full": found})

    return run


def shared_at_least(n: int, size: int, similarity: Fraction) -> int:
    """How many values of a sketch of ``n`` values a linked document shares at least."""
    if n < size:
        return math.ceil(similarity * n)
    p, below, least = float(similarity), 0.0, 0
    while least < size and (below := below + math.comb(size, least) * p**least * (1 - p) ** (size - least)) <= LOST:
        least += 1
    return max(1, least)


def components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, similarity: Fraction = SIMILARITY, sketch: int = SKETCH, carried: tuple[str, ...] = ()) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id`` (the smallest id reachable, itself included), ``kept`` (whether that is its own id), ``set_key``.

    Where rows of one id differ in text, each is linked by its own set. ``carried`` columns come along.
    """
    signed = docs.select(F.col(doc_id).cast("long").alias("id"), *carried, _signatures(words, sketch)(F.col(text)).alias("s"))
    signed = materialize(signed.select("id", *carried, "s.*"), "sketches")
    some = signed.where("set_key is not null and id is not null")
    firsts = some.groupBy("set_key").agg(F.min(F.struct(F.col("id").alias("rep"), "tie")).alias("rep"))
    sketches = some.groupBy("set_key").agg(F.first("sketch").alias("sketch"))
    reps = materialize(firsts.join(sketches, "set_key").select("rep", "sketch"), "sets")

    values = reps.select("rep", F.size("sketch").alias("size"), F.explode("sketch").alias("bucket"))
    often = values.groupBy("bucket").agg(F.count("*").alias("times")).where("times > 1")
    listed = values.join(often, "bucket").groupBy("rep", "size").agg(F.sort_array(F.collect_list(F.struct("times", "bucket"))).alias("values"))
    prefix = F.create_map(*[F.lit(x) for n in range(1, sketch + 1) for x in (n, n - shared_at_least(n, sketch, similarity) + 1)])
    room = prefix[F.col("size")] - (F.col("size") - F.size("values"))  # values met once come first and make no list
    # a document of which the most retained values are common is the one that the most others are like: it makes the best hub
    common = F.aggregate("values", F.lit(0).cast("long"), lambda total, v: total - v["times"]).alias("rank")
    listed = listed.withColumn("room", room).where("room > 0").select(F.explode(F.slice("values", F.lit(1), F.col("room"))).alias("v"), F.col("rep").alias("id"), common)
    groups = materialize(crowded(listed.select("v.bucket", "id", "rank")), "lists")

    wanted = groups.select(F.col("id").alias("rep")).distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    full = texts.join(wanted.select(F.col("rep.rep").alias("doc")).distinct(), "doc", "left_semi").select("doc", _sets(words)("text").alias("s"))
    full = full.select(F.struct(F.col("doc").alias("rep"), F.col("s.tie").alias("tie")).alias("rep"), "s.full")
    sets = materialize(full.join(wanted, "rep", "left_semi").dropDuplicates(["rep"]), "full")
    num, den = similarity.numerator, similarity.denominator

    def verify(pairs: DataFrame) -> DataFrame:
        def side(df: DataFrame, column: str, name: str) -> DataFrame:
            return df.select(F.col("rep").alias(name), F.col(column).alias(column + "_" + name))

        near = pairs.join(side(reps, "sketch", "a"), "a").join(side(reps, "sketch", "b"), "b")
        union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, sketch)
        both = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
        full = F.size(union) < sketch
        near = near.where((full & (den * both >= num * F.size(union))) | (~full & (both >= shared_at_least(sketch, sketch, similarity)))).select("a", "b")
        exact = near.join(side(sets, "full", "a"), "a").join(side(sets, "full", "b"), "b")
        shared = F.size(F.array_intersect("full_a", "full_b"))
        return exact.where(F.lit(den) * shared >= F.lit(num) * (F.size("full_a") + F.size("full_b") - shared)).select("a", "b")

    def narrow(members: DataFrame) -> DataFrame:
        """Members on the lists of the rarest values of their full sets, of which two linked sets share one; ``left``: values from there on."""
        classes = members.select("id", "c").distinct()
        values = sets.join(classes.select(F.col("id").alias("rep")), "rep").select(F.col("rep").alias("id"), F.size("full").alias("n"), F.explode("full").alias("bucket"))
        often = values.groupBy("bucket").agg(F.count("*").alias("times")).where("times > 1")
        ranked = values.join(often, "bucket").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("times", "bucket"))).alias("values"))
        ranked = ranked.withColumn("alone", F.col("n") - F.size("values"))  # values met nowhere else come first
        ranked = ranked.withColumn("room", F.col("n") - F.ceil(F.col("n") * num / den).cast("int") + 1 - F.col("alone")).where("room > 0")
        rare = ranked.select("id", "n", "alone", F.posexplode(F.slice("values", F.lit(1), F.col("room"))).alias("at", "v"))
        return rare.join(classes, "id").select("v.bucket", "id", F.lit(0).alias("rank"), "c", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left"))

    # at the first value that two sets share they can have no more in common than what either still has
    found = link(groups, verify, narrow, f"least(x.left, y.left) * {num + den} >= {num} * (x.n + y.n)")
    of_set = firsts.join(found, firsts.rep == found.id, "left").select("set_key", F.coalesce("component", "rep").getField("rep").alias("component"))
    labels = signed.select("id", *carried, "n", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component"))
    return labels.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"), "set_key", *carried)
