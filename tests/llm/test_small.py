"""Operators against brute force on small tables with nulls, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import random
import subprocess
import sys
import tracemalloc
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from plan_nodes import ran
from quarterdeck.llm import decontam, language, lines, linking, near_dup, order_minhash, passages, pieces, queries, sketch, suffix_array, suffix_dedup, token_counts, url_filter, window_dedup

NO_ID = 1 << 63
SCHEMA = "doc_id long, text string, key string, bucket long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]

    def some(a, b):
        return " ".join(rng.choice(words) for _ in range(rng.randint(a, b)))

    common = some(60, 60)
    out = [(i, some(0, 40) + (" " if i % 3 else "\n") + common + "\n" + some(0, 40)) for i in range(60)]
    base = some(80, 80).split()
    for i in range(100, 130):  # near copies
        own = list(base)
        own[rng.randrange(80)] = f"e{i}"
        out.append((i, " ".join(own)))
    return out + [(500, None), (None, common), (None, common), (7, out[7][1]), (7, out[7][1]), (501, ""), (502, "x" * 400), (503, "x" * 300), (504, "ab " * 80), (505, " \n "), (506, "one"), (507, "One")]


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for it in range(300):
        n, k = rng.randint(1, 150), rng.choice([1, 2, 3, 250])
        t = np.array([rng.randrange(k) for _ in range(n)], np.uint8)
        t = np.concatenate([t[: rng.randint(1, n)]] * rng.randint(1, 4) + [t]) if it % 3 == 0 else t
        raw = bytes(t)
        order = suffix_array.suffix_array(t)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        prefix = suffix_array.common_prefixes(t, order)
        for a, b in zip(order.tolist(), order.tolist()[1:]):
            same = 0
            while max(a, b) + same < len(raw) and raw[a + same] == raw[b + same]:
                same += 1
            assert prefix[b] == same


def test_suffix_array_of_a_large_alphabet():
    rng = np.random.default_rng(2)
    t = np.concatenate([rng.integers(0, 3000, 2500)] * 2 + [np.zeros(40, np.int64), rng.integers(0, 3000, 500)])
    listed = t.tolist()
    assert suffix_array.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: listed[i:])


@pytest.mark.parametrize("hot", [3, 10**6])
def test_repeated_bytes(spark, rows, hot):
    got = suffix_dedup.remove_repeated_bytes(table(spark, rows).repartition(4), hot_least=hot).select("doc_id", "text", "removed.n_removed", "removed.kept_sha256").collect()
    low = {}
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            low[raw[k : k + 50]] = min(low.get(raw[k : k + 50], NO_ID), NO_ID if i is None else i)
    want = collections.Counter()
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if low[raw[k : k + 50]] < (NO_ID if i is None else i):
                gone[k : k + 50] = b"\1" * 50
        want[i, t, sum(gone), hashlib.sha256(bytes(c for c, g in zip(raw, gone) if not g)).hexdigest()] += 1
    assert collections.Counter(map(tuple, got)) == want


def test_null_ids_next_to_the_largest_id(spark):
    """A null id is larger than every id, the largest long too, and neither row takes the other's removals."""
    rng = random.Random(5)
    one, two, three = ("".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(3))
    top = 2**63 - 1
    docs = [(top, one + three), (None, "##" + one + "#" + two), (top - 1, two), (top - 2, "." + three)]
    got = suffix_dedup.remove_repeated_bytes(table(spark, docs)).select("doc_id", "removed.n_removed", "removed.starts").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {top: (90, [90]), None: (180, [2, 93]), top - 1: (0, []), top - 2: (0, [])}
    items = spark.createDataFrame([(1, "zero one two three four five six seven eight nine ten eleven twelve")], "item_id long, text string")
    words = [(i, items.first()["text"] if i in (top, None) else "none at all") for i in (top, top - 1, None)]
    assert {r["doc_id"] for r in decontam.contaminated(table(spark, words), items).collect()} == {top, None}


@pytest.mark.parametrize("hot", [3, 10**6])
def test_repeated_words(spark, rows, hot):
    got = window_dedup.remove_repeated_words(table(spark, rows).repartition(4), hot_least=hot).select("doc_id", "text", "removed.n_removed", "removed.kept_sha256").collect()
    times = collections.Counter()
    for _, t in rows:
        w = (t or "").encode().split()
        times.update(tuple(w[k : k + 35]) for k in range(len(w) - 34))
    want = collections.Counter()
    for i, t in rows:
        w = (t or "").encode().split()
        gone = bytearray(len(w))
        for k in range(len(w) - 34):
            if times[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = b"\1" * 35
        want[i, t, sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()] += 1
    assert collections.Counter(map(tuple, got)) == want


def smallest(sets, linked):
    """Smallest member reachable from each."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and linked(sets[a], sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in sets}


def word_set(text, n):
    w = (text or "").lower().split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_near_duplicates(spark, rows):
    own = [(i, t) for i, t in rows if i is not None]
    sets = {i: word_set(t, 3) for i, t in own}
    want = smallest(sets, lambda a, b: 100 * len(a & b) >= 85 * len(a | b))
    got = near_dup.components(table(spark, rows), words=3, similarity=Fraction(85, 100)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_near_duplicates_of_one_group_with_more_and_fewer_changes(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"b{i}" for i in range(90)]
    texts = {}
    for i in range(160):
        own = list(base)
        for place in rng.sample(range(90), rng.randrange(12)):
            own[place] = f"e{rng.randrange(40)}"
        texts[i] = " ".join(own)
    sets = {i: word_set(t, 3) for i, t in texts.items()}
    want = smallest(sets, lambda a, b: 100 * len(a & b) >= 85 * len(a | b))
    assert len(set(want.values())) > 5
    calls, across = [], linking._across
    monkeypatch.setattr(linking, "_across", lambda *a: calls.append(1) or across(*a))
    got = near_dup.components(table(spark, list(texts.items())), words=3, similarity=Fraction(85, 100)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert calls


def test_near_duplicates_cut_short(spark):
    rng = random.Random(12)
    texts, want = {}, {}
    hashed = lambda w: near_dup.shingles(" ".join(w), 3).view(np.int64)
    for k in range(0, 10, 2):  # the part that the copy lacks has small hashes, so it fills much of the longer text's sketch
        words = [f"c{rng.randrange(10**9)}" for _ in range(87)]
        short = list(words)
        for _ in range(15):
            words.append(min((f"c{rng.randrange(10**9)}" for _ in range(60)), key=lambda x: hashed([*words[-2:], x])[0]))
        assert len(hashed(short)) == 85 and len(hashed(words)) == 100
        assert np.isin(np.sort(hashed(words))[:32], hashed(short)).sum() < 20
        texts[k], texts[k + 1] = " ".join(words), " ".join(short)
        want[k] = want[k + 1] = k
    got = near_dup.components(table(spark, list(texts.items())), words=3, similarity=Fraction(85, 100)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("similarity", [Fraction(4, 5), Fraction(85, 100), Fraction(9, 10)])
def test_shared_values_hold_for_sets_of_unequal_size(similarity):
    p, least = float(similarity), near_dup.shared_at_least(32, 32, similarity)
    assert sum(math.comb(32, k) * p**k * (1 - p) ** (32 - k) for k in range(least)) <= 1e-8


def test_repeated_lines(spark, rows):
    own = [(i, t) for i, t in dict.fromkeys(rows) if i is not None]
    first = {}
    for i, t in sorted(own):
        for k, line in enumerate((t or "").split("\n")):
            if line and not line.isspace():
                first[line] = min(first.get(line, (i, k)), (i, k))
    want = smallest({at: lines.shingle_set(x) for x, at in first.items()}, lambda a, b: 5 * len(a & b) >= 4 * len(a | b))
    got = {r["doc_id"]: r for r in lines.remove_repeated_lines(table(spark, [r for r in rows if r[0] is not None])).select("doc_id", "lines.*").collect()}
    for i, t in own:
        every = [] if t is None else t.split("\n")
        kept = [x for k, x in enumerate(every) if not x or x.isspace() or want[first[x]] == (i, k)]
        assert (got[i]["n_lines"], got[i]["n_removed"], got[i]["kept"]) == (len(every), len(every) - len(kept), None if t is None else "\n".join(kept))


def test_repeated_lines_of_few_distinct_shingles(spark):
    own = ["-" * n for n in range(7, 13)] + ["=" * n for n in range(8, 11)] + [("-=" * 9)[:n] for n in range(8, 14)] + [("abc" * 9)[:n] for n in (9, 10, 11, 12)] + ["abcdefgh", "abcdefghi", "abcdefg"]
    want = smallest(dict(enumerate(map(lines.shingle_set, own))), lambda a, b: 5 * len(a & b) >= 4 * len(a | b))
    got = lines.remove_repeated_lines(table(spark, list(enumerate(own)))).select("doc_id", "lines.kept").collect()
    assert {r["doc_id"]: r["kept"] for r in got} == {k: x if want[k] == k else "" for k, x in enumerate(own)}


def test_decontamination(spark):
    rng = random.Random(5)
    words = [f"v{i}" for i in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate((3, 5, 30, 44, 300))] + [(90, None), (91, "")]
    docs = []
    for k, text in items[:5]:
        pad = " ".join(rng.choice(words) for _ in range(50))
        docs += [(10 * k, pad + " " + text.upper() + " " + pad), (10 * k + 1, pad)]
        edited = text.split()
        if len(edited) > 40:
            edited[3] = "changed"
        docs.append((10 * k + 2, "  ".join(edited)))
    docs += [(900, None), (901, ""), (None, items[2][1]), (0, docs[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(table(spark, docs), bench).collect()}
    assert got == {(10 * k + j, k) for k in range(5) for j in (0, 2)} | {(None, 2)}


def test_decontamination_of_documents_shorter_than_the_item(spark):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(400)]
    item, other = ([rng.choice(words) for _ in range(41)] for _ in range(2))
    cut = {1: item[:-1], 2: item[1:], 3: item[2:-2], 4: item[:20], 5: item[:-1] + ["more"] * 40, 6: other[:40], 7: item[:3], 8: item}
    bench = spark.createDataFrame([(0, " ".join(item)), (1, " ".join(other)), (2, " ".join(item[:-1]))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(table(spark, [(k, " ".join(w)) for k, w in cut.items()]), bench).collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 0), (5, 0), (6, 1), (8, 0), (1, 2), (2, 2), (3, 2), (5, 2), (8, 2)}
    assert got[1, 0]["similarity"] == pytest.approx(36 / 37) and got[3, 0]["similarity"] == pytest.approx(33 / 37)
    assert [(got[k]["first_word"], got[k]["n_words"]) for k in ((1, 0), (3, 0), (1, 2), (8, 0))] == [(0, 40), (0, 37), (0, 40), (0, 41)]


def test_order_minhash(spark, rows):
    got = order_minhash.fingerprints(table(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = collections.Counter()
    for k, (i, t) in enumerate(order):
        own, other = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(own) // 2
        want[i, len(own), hashlib.sha256((own[: len(own) - half] + other[:half]).encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_order_minhash_of_short_texts_feels_order(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        w = [f"s{x}" for x in rng.sample(range(10**6), 30)]
        texts.append((" ".join(w), " ".join(w[15:] + w[:15])))
    df = spark.createDataFrame(texts + [("a b", "b a"), ("a b c", "a b c"), ("one", "one"), ("one", "two"), ("", " ")], "x string, y string")
    df = order_minhash.signed(order_minhash.signed(df, "x", "own"), "y", "swapped")
    got = [tuple(r) for r in df.select(order_minhash.likeness(df["own"], df["swapped"]), "own", "swapped").collect()]
    assert 0.3 < sum(x for x, _, _ in got[:60]) / 60 < 0.6  # a pair of the whole text turns about every other time
    assert [x for x, _, _ in got[60:]] == [0, 1, 1, 0, 1]
    assert all([e & 63 for e in s] == list(range(64)) for _, *both in got[:64] for s in both)
    assert got[64][1:] == ([], [])


def test_order_minhash_against_the_ring(spark):
    from pyspark.sql import functions as F

    from quarterdeck.llm import native

    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(n)) for n in (2, 3, 5, 30, 200)]
    df = native.with_grams(spark.createDataFrame([(t,) for t in texts], "text string").withColumn("w", native.word_array(F.col("text"))), "w", 2, "g")
    df = order_minhash.signed(native.numbered(df, "g", "h", order_minhash.PLACE_BITS), "text", "own")
    pair = {}

    def chosen(r):
        ring = sorted(r["h"])
        for j in range(64):
            at = sum(h < (j << 58) - (1 << 63) for h in ring)
            yield tuple(sorted(ring[(at + k) % len(ring)] & ((1 << 28) - 1) for k in range(min(2, len(ring)))))

    for r in df.collect():
        for j, (places, e) in enumerate(zip(chosen(r), r["own"], strict=True)):
            assert e & 63 == j
            assert pair.setdefault(tuple(r["g"][p] for p in places), e >> 6) == e >> 6
    assert len(set(pair.values())) == len(pair)


def test_token_counts(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file(queries.WORD_BPE)
    own = Tokenizer.from_file(path)
    texts = ["a<|endoftext|>b <|startoftext|>", "x\x1cy z", "á  b", "ΑΣ ΑΣ", "½ Ⅷ ² a²b", "é é", "", "İstanbul isn't\t12,3", "word " * 3000, None]
    got = token_counts.token_counts(table(spark, list(enumerate(texts))), path).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {k: len(own.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts)}


def test_url_rules(spark):
    urls = [None, "", "no scheme", "HTTP://EXAMPLE.org/es/x?y", "http://example.org/en/12", "x://a.example.org", "x://badexample.org/es/", "x://s.com/de/", "x://s.com/fr/1#z", "x://h.net/a.org/", "x://é.org/ü" + "y" * 300]
    got = url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), queries.URL_RULES).orderBy("page_id").collect()
    assert [r["rule"] for r in got] == [None, None, None, "example.org/es/", "example.org/en/1", None, "org/", "com/de/", "com/fr/", None, "org/"]
    assert [r["verdict"] for r in got][3:5] == ["block", "block"] and got[3]["host"] == "example.org" and got[7]["verdict"] == "block"
    many = url_filter.Automaton(["*." + "h" * 40 + f"{k}/*/end" for k in range(20)])
    assert many.fits(["." + "h" * 40 + "7/a/end", "." + "h" * 40 + "7/a/b/end"])[:, 7].tolist() == [True, False]


def test_pieces_round_trip_and_best_path(spark):
    path = queries.tokenizer_file(queries.PIECES)
    texts = ["Hello  world\n x\ty ", "", "  a", " ", "\n\n", "é日本🙂 naïve", None, "the quick " * 400]
    both = pieces.decode(pieces.encode(table(spark, list(enumerate(texts))), path), path).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in both)
    model = pieces.read_model(path)
    own = pieces.Pieces(model)
    text = {p: s for p, s in zip(model["plain"], model["score"].tolist())}

    def best(raw):  # all ways to cut a short ASCII unit
        top = [0.0] + [-1e18] * len(raw)
        for j in range(1, len(raw) + 1):
            for i in range(j):
                if raw[i:j] in text and not (j - i == 1 and raw[i] < 32):
                    top[j] = max(top[j], top[i] + text[raw[i:j]])
        return top[-1]

    for word in (" the", " token", " zebra", " worldwide"):
        assert own.best(word.replace(" ", pieces.MARK))[1] == pytest.approx(best(word.encode()))


def _all_cuts(unit, score_of, unknown):
    """The best score over every way to cut a unit into pieces; only characters that are no piece may go as bytes."""
    if not unit:
        return 0.0
    ways = [score_of[unit[:k]] + _all_cuts(unit[k:], score_of, unknown) for k in range(1, len(unit) + 1) if unit[:k] in score_of]
    if unit[0] not in score_of:
        ways.append(unknown + _all_cuts(unit[1:], score_of, unknown))
    return max(ways)


@pytest.mark.parametrize("scores", ["zipf", "file"])
def test_pieces_against_every_cut_with_bytes_of_unknown_characters(scores):
    import sentencepiece

    path = queries.tokenizer_file(queries.PIECES)
    model = pieces.read_model(path, scores)
    file = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(file.get_piece_size()) if not (file.is_byte(i) or file.is_control(i) or file.is_unknown(i))]
    score_of = {file.id_to_piece(i): float(model["score"][i]) for i in normal}
    coder = pieces.Pieces(model)
    for unit in ["▁naïve", "é😀the", "漢字かな", "▁𐍈ing", "\x00a\x01", "😀😀", "▁Straße", "a\u0301b", "▁日本語text"]:
        ids, gain = coder.best(unit)
        assert gain == pytest.approx(_all_cuts(unit, score_of, model["unknown"])), unit
        assert b"".join(model["plain"][i] for i in ids).decode() == unit.replace("▁", " ")


def test_pieces_in_one_pass_with_small_caches_and_lots(spark, monkeypatch):
    """Batches cut into lots, a cache that empties all the time, other columns kept, columns of the same names replaced."""
    path = queries.tokenizer_file(queries.PIECES)
    texts = [None, "", "a  b\n c", "é日本🙂 naïve", "the quick brown fox " * 300, "x" * 5000, " lead", "tail ", "the quick", "word%d " * 50]
    rows = [(k, t, [k, None], "old") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more array<int>, IDS string")
    both = pieces.encode(docs, path, decoded="decoded")
    assert both.columns == ["doc_id", "text", "more", "ids", "decoded"]
    got = {r["doc_id"]: r for r in both.collect()}
    coder = pieces.Pieces(pieces.read_model(path))
    for k, t in enumerate(texts):
        assert (got[k]["text"], got[k]["more"], got[k]["decoded"]) == (t, [k, None], t or "")
        assert got[k]["ids"] == coder.encode(t).tolist()
    in_place = pieces.encode(docs.select("doc_id", "text"), path, ids="text").collect()
    assert {r["doc_id"]: r["text"] for r in in_place} == {k: r["ids"] for k, r in got.items()}

    monkeypatch.setattr(pieces, "CACHE_BYTES", 700)
    monkeypatch.setattr(pieces, "LOT", 1)
    small = pieces.Pieces(pieces.read_model(path))
    assert [x.tolist() for x in small.encode_lot(texts)] == [got[k]["ids"] for k in range(len(texts))]
    assert len(small.marked) <= 3 and small.marked.size <= 700
    monkeypatch.setattr(pieces, "TOGETHER", 30)
    import pyarrow as pa

    cuts = list(pieces._lots(pa.array(texts, pa.string())))
    assert [c[0] for c in cuts] == [0] + [c[1] for c in cuts[:-1]] and cuts[-1][1] == len(texts) and len(cuts) > 3


def test_pieces_of_many_units_are_those_of_each():
    coder = pieces.Pieces(pieces.read_model(queries.tokenizer_file(queries.PIECES)))
    units = ["▁the", "the", "▁Straße###", "漢", "é漢字x", "😀a", "\x00a", "a", "▁" * 3, "zqxj" * 9]
    lot = coder.best_of_lot([u.encode() for u in units])
    assert [np.frombuffer(x, np.int32).tolist() for x in lot] == [coder.best(u)[0] for u in units]
    texts = [None, "", " ", "a  b\n c\n\nd " * 3, "x" * 200, "one\ntwo"]
    together = coder.encode_lot(texts)
    other = pieces.Pieces(pieces.read_model(queries.tokenizer_file(queries.PIECES)))
    assert [x.tolist() for x in together] == [other.encode(t).tolist() for t in texts]


def test_language(spark):
    rows = [(k, t, x) for k, (t, x) in enumerate([("the house is on the hill and the road", "en"), ("la casa está en la colina y el camino", "es")] * 12 + [(None, "en"), ("123 !!", "es"), ("the hill", None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    model = language.fit(docs, F.col("doc_id") >= 0)
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert all(got[k]["lang_pred"] == x for k, t, x in rows[:24]) and got[26]["lang_pred"] == "en"
    assert [got[k]["lang_pred"] for k in (24, 25)] == ["und", "und"] and got[24]["score"] == 0
    assert language.fit(docs, F.lit(False)) is None


def test_language_fit_holds_a_few_rows_at_a_time():
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"] if k % 2 else ["uno", "dos", "tres", "cinco"]) for _ in range(20)) for k in range(600)]
    langs = ["en" if k % 2 else "es" for k in range(600)]
    tracemalloc.start()
    model = language.fit_texts(texts, langs, landmarks_per_language=4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # a row per text would be 79 MB
    tracemalloc.start()
    assert language.score_texts(model, texts)[0] == langs
    assert tracemalloc.get_traced_memory()[1] < 14e6  # a product of 128 rows takes 17 MB and more
    tracemalloc.stop()


def test_sketch_of_hashes_that_are_minima():
    hashes = np.unique(np.random.default_rng(5).integers(0, 1 << 58, 8000, dtype=np.uint64))  # the smallest of many lie at the low end
    own = sketch.Sketch(16)
    own.add(hashes)
    own.add(hashes[:100])
    tell = sketch.Repeated(list(own.more), 16, hashes[:0], len(hashes)).test(hashes)
    assert tell[:100].all() and tell[100:].mean() < 0.04  # 0.12 where the first row takes their own first bits


def test_sketch_of_lines_lets_few_single_lines_through():
    hashes = np.random.default_rng(6).integers(1, 1 << 63, (2500, 1 + lines.BANDS), dtype=np.uint64)
    scale = 10  # the maps at a thousandth, and the hashes of 0.5 GB likewise
    own = sketch.Sketch(lines.SKETCH["bits"] - scale, lines.SKETCH["depth"])
    own.add(hashes.ravel())
    tell = sketch.Repeated(list(own.more), own.bits, hashes[:0, 0], hashes.size).test(hashes.ravel())
    assert own.more.nbytes == sketch.Sketch().more.nbytes >> scale
    assert tell.reshape(hashes.shape).any(axis=1).mean() < 0.08  # 0.2 with two rows of twice as many cells


def test_empty_tables(spark):
    none = table(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
    assert window_dedup.remove_repeated_words(none).count() == 0
    assert lines.remove_repeated_lines(none).count() == 0
    assert near_dup.components(none).count() == 0
    assert decontam.contaminated(table(spark, [(1, "a b")]), bench).count() == 0
    assert order_minhash.fingerprints(none).count() == 0


def test_very_large_group_in_chunks(monkeypatch):
    monkeypatch.setattr(passages, "CHUNK", 100)
    hot = passages._Hot(window_dedup.solve_words)
    content = np.array([5], np.uint64).tobytes()
    out = []
    for doc in range(30):
        out += hot.add(7, doc, content, np.array([(doc, 0, 3)], passages.PLACE).tobytes())
    out += hot.flush()
    assert {d for b in out for d in b["doc"].to_pylist()} == set(range(30))


def test_long_words_that_agree_modulo_a_power_of_two(spark):
    """Thue-Morse words of 1024 bytes and their opposites have equal sums modulo 2**64."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    w, v = ("".join("ab"[b ^ k] for b in bits) for k in (0, 1))
    lead = " ".join(f"q{i}" for i in range(34))
    docs = table(spark, [(1, f"{lead} {w}"), (2, f"{lead} {v}"), (3, w), (4, v), (5, f"{lead} {w}")])
    removed = {r["doc_id"]: r["removed"]["n_removed"] for r in window_dedup.remove_repeated_words(docs).collect()}
    assert removed == {1: 35, 2: 0, 3: 0, 4: 0, 5: 35}
    same = {r["doc_id"]: r["component_id"] for r in near_dup.components(docs, words=3, similarity=Fraction(85, 100)).collect()}
    assert same[3] == 3 and same[4] == 4


def test_bits_of_lines_bound_their_difference():
    rng = random.Random(12)
    for _ in range(200):
        x = "".join(rng.choice("ab c") for _ in range(rng.randint(8, 400)))
        y = list(x)
        for _ in range(rng.randint(0, 6)):
            y[rng.randrange(len(y))] = rng.choice("abz")
        y = "".join(y)
        a, b = lines.line_bits([x, y])
        differing = sum(bin(int(p ^ q) & (2**64 - 1)).count("1") for p, q in zip(a.tolist(), b.tolist()))
        one, two = lines.shingle_set(x), lines.shingle_set(y)
        assert differing <= len(one ^ two)
        if lines.similar(x, y):
            assert 9 * differing <= len(x) + len(y) - 14
        assert len(lines.shingle_hashes(x)) == len(one)


def test_lines_of_a_large_band(spark, monkeypatch):
    """Bands beyond the limit are listed anew by rare shingles: the same result."""
    rng = random.Random(13)
    stem = "".join(rng.choice("abcdefgh ") for _ in range(90))
    own = []
    for k in range(120):  # a band of many families, each of near copies
        family = stem[:60] + f"family {k % 24:05d} has its own end {k % 24 * 7919:08d}"
        own.append(family if k < 24 else family[:50] + rng.choice("xyz") + family[51:])
    docs = table(spark, list(enumerate(own)))
    results = []
    for large in (400, 2):
        monkeypatch.setattr(lines, "LARGE", large)
        results.append(sorted((r["doc_id"], r["lines"]["kept"]) for r in lines.remove_repeated_lines(docs).collect()))
    assert results[0] == results[1] and any(kept == "" for _, kept in results[0])


def test_shingles_of_lines_come_from_one_python_node(spark):
    """A column function read both by a size and by an explode ran twice, in two workers a task."""
    own = ["abcdefghijk", "aaaaaaaaaaaa", "short", None, "abcdefghxyz" * 9]
    frame = spark.createDataFrame([((k, 0, 1), (k, 0, 0), x) for k, x in enumerate(own)], "id struct<doc: long, twin: long, number: int>, c struct<doc: long, twin: long, number: int>, line string")
    got = lines.shingle_rows(frame)
    want = sorted((k, len(lines.shingle_set(x)), h) for k, x in enumerate(own) if x and len(x) >= 8 for h in lines.shingle_hashes(x).tolist())
    assert sorted((r["id"]["doc"], r["n"], r["bucket"]) for r in got.collect()) == want and all(r["c"]["doc"] == r["id"]["doc"] for r in got.collect())
    again = got.groupBy("bucket").agg(F.count("*"), F.max("n"))
    again.collect()
    assert [name for name, _ in ran(again)].count("MapInArrow") == 1 and not [name for name, _ in ran(again) if "EvalPython" in name]


def test_line_operator_needs_no_pandas():
    """Each Python worker would hold pandas, 27 MB, from then on."""
    code = "import sys; import quarterdeck.llm.lines; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))).returncode == 0


def test_lines_are_compared_with_many_in_a_row():
    rng = random.Random(17)
    stem = "".join(rng.choice("abcdef ") for _ in range(80))
    some = [stem[:k] + rng.choice("xyz") + stem[k + 1 :] for k in range(0, 80, 5)] + [stem[:k] for k in (4, 7, 8, 40, 62, 66, 70, 80)] + ["--------", "----------"]
    pairs = [(x, y) for x in some for y in some]
    assert lines.similar_to_each(*zip(*pairs)) == [lines.similar(x, y) for x, y in pairs]


def test_later_links_join_the_components_found(spark):
    first, later = [(1, 2), (2, 3), (5, 6), (8, 9)], [(3, 6), (9, 10), (11, 12), (12, 10), (1, 3)]
    frame = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    want = sorted(map(tuple, linking.connected(frame(first + later)).collect()))
    assert sorted(map(tuple, linking._joined(linking.connected(frame(first)), frame(later)).collect())) == want
