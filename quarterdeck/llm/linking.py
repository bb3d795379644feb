"""From buckets of like items to components of verified links, as joins and aggregates.

Items that share a bucket are candidates. Within a bucket no list of all pairs is made: members are first held against one hub, the member
that is most like the rest by its ``rank``. What that links is one component, and only pairs across the components a bucket still holds go
on: first the members outside the largest component against some hubs of it, then those of the buckets that stay mixed one against the
other, after the caller has put them into tighter buckets. So every candidate pair is either verified or already connected, or can be no link.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.session import materialize

Verify = Callable[[DataFrame], DataFrame]  # pairs (a, b) to those that are links
Narrow = Callable[[DataFrame], DataFrame]  # members (bucket, id, rank, c) to the members of tighter buckets, with what ``fits`` reads
HUBS = 16  # members of a bucket's largest component that the others are held against before all are


def connected(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of the ids in links ``a, b``, by alternating star contraction.

    Each round is two joins on the edges left; rounds grow with the logarithm of the longest chain. The edges are written after each round,
    so nothing is computed twice and a lost executor costs a re-read.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        state = tuple(now)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """``found`` (``id, component``) after the links ``more`` as well: only the components that these touch are contracted again."""
    ends = found.select("id", "component")
    for side in ("a", "b"):
        more = more.join(ends.select(F.col("id").alias(side), F.col("component").alias(f"c_{side}")), side, "left")
    between = more.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")).where("a != b")
    moved = materialize(connected(between), "moved")
    old = ends.join(moved.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
    return old.select("id", F.coalesce("to", "component").alias("component")).unionByName(moved.join(ends.select("id"), "id", "left_anti"))


def crowded(members: DataFrame) -> DataFrame:
    """Members ``bucket, id, rank`` of buckets that hold more than one id, with the bucket's ``hub``: its smallest (rank, id)."""
    ends = members.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min(F.struct("rank", "id")).alias("hub"))
    return members.join(ends.where("first < last").select("bucket", "hub"), "bucket")


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Each pair once, the smaller id as ``a``."""
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def link(groups: DataFrame, verify: Verify, narrow: Narrow | None = None, fits: str = "true", sift: Verify | None = None) -> DataFrame:
    """``id, component`` of every id that has a link; ``groups`` comes from ``crowded`` and is read several times, so write it first.

    ``fits`` is a condition on members ``x`` and ``y`` of one narrowed bucket, true in one of the buckets that two linked ones share.
    ``sift`` takes pairs that can be no link away before they are written, from what is cheap to read of both.
    """
    sift = sift or (lambda pairs: pairs)
    best = groups.where("id != hub.id").groupBy("id").agg(F.min("hub").alias("hub")).select("id", F.col("hub.id").alias("hub"))
    tested = materialize(sift(_pairs(best, "id", "hub")), "pairs")
    found = materialize(connected(materialize(verify(tested), "links")), "components")
    for last in (False, True):
        mixed = materialize(_mixed(groups, found), "mixed")
        if mixed.isEmpty():
            break
        if last:
            pairs = _across(materialize(narrow(mixed), "narrowed") if narrow else mixed, found, fits)
        else:
            pairs = _to_hubs(mixed, found)
        fresh = materialize(sift(pairs.join(tested, ["a", "b"], "left_anti")), "pairs")
        if fresh.isEmpty():
            continue
        tested, more = tested.unionByName(fresh), materialize(verify(fresh), "links")
        if not more.isEmpty():
            found = materialize(_joined(found, more), "components")
    return found


def _mixed(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their component ``c``."""
    labelled = groups.join(found, "id", "left").select("bucket", "id", "rank", F.coalesce("component", "id").alias("c"))
    several = labelled.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("bucket")
    return labelled.join(several, "bucket")


def _marked(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with ``main``, the largest component in their bucket."""
    sizes = found.groupBy(F.col("component").alias("c")).agg(F.count("*").alias("size"))
    sized = members.join(sizes, "c", "left").withColumn("size", F.coalesce("size", F.lit(1)))
    return members.join(sized.groupBy("bucket").agg(F.max(F.struct("size", "c")).getField("c").alias("main")), "bucket")


def _to_hubs(mixed: DataFrame, found: DataFrame) -> DataFrame:
    """The members outside a bucket's largest component, each against up to ``HUBS`` members of it: the best of as many parts by hash."""
    marked = _marked(mixed, found)
    part = F.pmod(F.xxhash64("id"), F.lit(HUBS)).alias("part")
    chosen = marked.where("c = main").groupBy("bucket", part).agg(F.min(F.struct("rank", "id")).getField("id").alias("hub"))
    return _pairs(marked.where("c != main").select("bucket", "id").join(chosen, "bucket"), "id", "hub")


def _across(members: DataFrame, found: DataFrame, fits: str) -> DataFrame:
    """The pairs that share a bucket and not a component; one of them is outside the bucket's largest component."""
    outside = _marked(members, found).where("c != main").drop("main")
    met = outside.alias("x").join(members.alias("y"), "bucket").where("x.c != y.c").where(fits)
    return _pairs(met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), "a", "b")
