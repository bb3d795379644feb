"""Benchmark passages in documents: SimHash windows, multi-index Hamming blocks, weighted shingles; column expressions and joins only.

Words are lower-cased (A-Z) runs of characters other than space and 9 to 13; shingles are ``SHINGLE`` words (items of fewer words: all of them).
Windows have the size of an item; a document of fewer words, but enough shingles to reach ``SIMILARITY``, is one window as a whole.
Only windows that share a shingle with such an item can be similar to it, so the others are never made. A window's fingerprint is the SimHash of its shingles, each weighing as often as it occurs. Fingerprints are cut
into ``BLOCKS`` blocks, and items are indexed under every block value within ``RADIUS // BLOCKS`` bits, which finds every item within
``RADIUS`` bits of the window. Candidates are then compared by weighted Jaccard similarity of their shingles: ``SIMILARITY`` or more counts. Of two
such texts at exactly 0.8 the fingerprints lie within the radius with probability 0.98, at 0.85 with 0.996, and equal ones always.

Null and empty texts and items hold nothing. Repeated rows of a document give one row for an item; of windows that tie the first counts. ``n_words`` is the number of words in the window.
The shingles and the index of the items are broadcast while they are no more than ``BROADCAST_ROWS`` rows, and joined by shuffle beyond.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.native import numbered, with_grams, word_array
from quarterdeck.llm.passages import NO_ID, gap, keyed
from quarterdeck.session import materialize

SHINGLE = 5
RADIUS, BLOCKS = 15, 4
SIMILARITY = (4, 5)
BROADCAST_ROWS = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WIDTH = 64 // BLOCKS


def _shingled(df: DataFrame, text: str, k: int) -> DataFrame:
    """``words`` and ``grams`` of a text."""
    words = word_array(F.translate(F.col(text), UPPER, LOWER))
    return with_grams(df.withColumn("words", words), "words", k, "grams")


def _lanes(largest: int) -> int:
    """Counters that fit in one 64-bit sum, wide enough for a window of the largest size."""
    return 8 if largest < 256 else 4 if largest < 65_536 else 2


def simhash(grams: Column, lanes: int) -> Column:
    """Bit ``b`` is set where most of the hashes have it set; ties are unset. Counters of several bits share a sum."""
    width = 64 // lanes
    ones, low = F.lit(sum(1 << (width * lane) for lane in range(lanes))), F.lit((1 << width) - 1)

    def counted(j: int) -> Column:
        """Bits ``j, j + width, ...`` of all hashes, added up in lanes."""
        return F.aggregate(grams, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, j).bitwiseAND(ones))

    def majority(j: int, total: Column) -> Column:
        out = F.lit(0).cast("long")
        for lane in range(lanes):
            count = F.shiftrightunsigned(total, width * lane).bitwiseAND(low)
            out = out.bitwiseOR(F.shiftleft((count * 2 > F.size(grams)).cast("long"), width * lane + j))
        return out

    bits = F.lit(0).cast("long")
    for j in range(width):
        bits = bits.bitwiseOR(F.get(F.transform(F.array(counted(j)), _bind(majority, j)), F.lit(0)))
    return bits


def _bind(f, j: int):
    return lambda x: f(j, x)


def _block(bits: Column, b: int) -> Column:
    return F.shiftrightunsigned(bits, WIDTH * b).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int")


def _masks() -> list[int]:
    """All block values of at most ``RADIUS // BLOCKS`` set bits."""
    return [sum(1 << b for b in chosen) for n in range(RADIUS // BLOCKS + 1) for chosen in combinations(range(WIDTH), n)]


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words``: the most similar window of a document for each item it holds."""
    found = contaminated_rows(keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))), items, item_id, item_text)
    best = found.groupBy("_doc", "item_id").agg(F.max(F.struct("similarity", (-F.col("first_word")).alias("at"), "n_words")).alias("best"))
    free, own = gap(docs, doc_id), F.col("_doc")
    if free is not None:
        own = F.when(own >= free, own + 1).otherwise(own)
    own = F.when(F.col("_doc") != NO_ID, own).alias("doc_id")
    return best.select(own, "item_id", "best.similarity", (-F.col("best.at")).alias("first_word"), "best.n_words")


def contaminated_rows(rows: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The same per row of ``keyed`` documents, by their ``_doc`` and ``_twin``."""
    known = items.select(F.col(item_id).alias("item_id"), word_array(F.translate(F.col(item_text), UPPER, LOWER)).alias("words"))
    known = known.withColumn("n_words", F.size("words")).where("n_words > 0").withColumn("k", F.least("n_words", F.lit(SHINGLE)))
    found = None
    for k, largest in sorted((r["k"], r["m"]) for r in known.groupBy("k").agg(F.max("n_words").alias("m")).collect()):  # at most SHINGLE rows
        part = _contaminated(rows, known.where(F.col("k") == k), k, largest)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.where("false").select("_doc", "_twin", F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("first_word"), F.lit(0).alias("n_words"))
    return found


def _contaminated(rows: DataFrame, known: DataFrame, k: int, largest: int) -> DataFrame:
    lanes, row = _lanes(largest), ["_doc", "_twin"]
    index = numbered(with_grams(known, "words", k, "grams"), "grams", "bag").drop("words")
    index = materialize(index.withColumn("bits", simhash(F.col("grams"), lanes)), "items")
    n_shingles = index.agg(F.sum(F.size("grams"))).first()[0]
    n_items = index.count()

    texts = _shingled(rows.select(*row, "text"), "text", k)
    shingles = index.select(F.explode("grams").alias("gram"), "n_words").distinct()
    # the outer form: no filter on the array's size is inferred and pushed into, and repeated for, each element below
    places = texts.select("_doc", "_twin", F.size("words").alias("size"), F.posexplode_outer("grams").alias("at", "gram"))
    # a bag of s shingles and one of t are at most s / t similar, so shorter documents than that are no window
    enough = (F.col("size") - (k - 1)) * SIMILARITY[1] >= (F.col("n_words") - (k - 1)) * SIMILARITY[0]
    hits = places.join(_sized(shingles, n_shingles), "gram").where(enough).withColumn("n_words", F.least("size", "n_words"))
    starts = F.sequence(F.greatest(F.col("at") + k - F.col("n_words"), F.lit(0)), F.least("at", F.col("size") - F.col("n_words")))
    hits = hits.where(F.greatest(F.col("at") + k - F.col("n_words"), F.lit(0)) <= F.least("at", F.col("size") - F.col("n_words")))
    spans = hits.groupBy("_doc", "_twin", "n_words").agg(F.array_distinct(F.flatten(F.collect_list(starts))).alias("starts"))
    spans = materialize(spans.groupBy(*row).agg(F.collect_list(F.struct("n_words", "starts")).alias("spans")), "spans")

    # only documents with hits are shingled again; their rows are sought by shuffle, as there are more of them in a larger corpus
    near = _shingled(rows.select(*row, "text").join(spans.hint("merge"), row), "text", k)
    near = near.select(*row, "grams", F.size("words").alias("size"), F.explode("spans").alias("span")).select(*row, "grams", "size", "span.*")
    windows = near.select(*row, "n_words", "grams", (F.col("size") == F.col("n_words")).alias("whole"), F.explode("starts").alias("first_word"))
    windows = windows.select(*row, "n_words", "first_word", "whole", F.slice("grams", F.col("first_word") + 1, F.col("n_words") - k + 1).alias("window"))
    windows = materialize(windows.withColumn("bits", simhash(F.col("window"), lanes)), "windows")

    masks = F.array(*[F.lit(m) for m in _masks()])
    blocks = F.explode(F.array(*[F.struct(F.lit(b).alias("b"), _block(F.col("bits"), b).alias("value")) for b in range(BLOCKS)])).alias("block")
    probes = windows.select(*row, "n_words", "first_word", "whole", "bits", blocks)
    entries = index.select("item_id", F.col("n_words").alias("m"), F.col("bits").alias("item_bits"), blocks)
    entries = entries.select("item_id", "m", "item_bits", "block.b", F.col("block.value").alias("value"), F.explode(masks).alias("mask"))
    entries = entries.select("item_id", "m", "item_bits", "b", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
    met = probes.select(*row, "n_words", "first_word", "whole", "bits", "block.b", "block.value").join(_sized(entries, n_items * BLOCKS * len(_masks())), ["b", "value"])
    of_size = (F.col("n_words") == F.col("m")) | (F.col("whole") & (F.col("n_words") < F.col("m")))
    met = met.where((F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits"))) <= RADIUS) & of_size)
    pairs = met.select(*row, "n_words", "first_word", "item_id").distinct()

    bags = numbered(windows.select(*row, "n_words", "first_word", "window"), "window", "bag").select(*row, "n_words", "first_word", _hashes("bag").alias("bag"))
    both = pairs.join(bags, [*row, "n_words", "first_word"]).join(_sized(index.select("item_id", _hashes("bag").alias("item_bag")), n_shingles), "item_id")
    shared = F.size(F.array_intersect("bag", "item_bag"))
    both = both.withColumns({"shared": shared, "all": F.size("bag") + F.size("item_bag") - shared})
    both = both.where(F.col("shared") * SIMILARITY[1] >= F.col("all") * SIMILARITY[0]).withColumn("similarity", F.col("shared") / F.col("all"))
    best = both.groupBy(*row, "item_id").agg(F.max(F.struct("similarity", (-F.col("first_word")).alias("at"), "n_words")).alias("best"))
    return best.select(*row, "item_id", "best.similarity", (-F.col("best.at")).alias("first_word"), "best.n_words")


def _hashes(bag: str) -> Column:
    """The numbered hashes without the places packed below them."""
    return F.transform(bag, lambda e: F.shiftright(e, 28))
