"""Vector codes against a plain search over all entries, on tables with unusable vectors, ties, repeated rows and clashing names."""

from __future__ import annotations

import random

import numpy as np
import pytest

from quarterdeck.llm import vector_codes
from quarterdeck.llm.hot import join_by_weight

SCHEMA = "vec_id long, embedding array<float>, label int, code string, row long, found long"


def plain(x, book):
    """Nearest entries by all distances, the lower of equal ones."""
    gap = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    at = [min(range(len(book)), key=lambda j: (row[j], j)) for row in gap]
    return at, [int(row[j]) for row, j in zip(gap, at)]


def test_nearest_is_that_of_all_entries():
    rng = random.Random(5)
    for k in range(60):
        n, d, e, most = rng.randint(1, 600), rng.randint(1, 9), rng.randint(1, 256), rng.choice([0, 3, 100, 10**6, 10**12])
        x, book = (np.array([[rng.randint(-most, most) for _ in range(d)] for _ in range(m)], object).reshape(m, d) for m in (n, e))
        if k % 3 == 0:
            book[e // 2 :] = book[: e - e // 2]
        at, far = vector_codes.nearest(x.astype(float) if most < 2**40 else x, book)
        want = plain(x, book)
        assert at.tolist() == want[0] and [int(v) for v in far] == want[1]


def vectors(n=90, dim=8):
    rng = np.random.default_rng(4)
    out = [(i, [float(v) for v in rng.normal(0, 0.2, dim).astype(np.float32)], i % 3, "c", 1, 2) for i in range(n)]
    out[5] = (5, out[4][1], 2, "c", 1, 2)  # equal vectors
    bad = [None, [None] * dim, [float("nan")] + [0.0] * (dim - 1), [float("inf")] * dim, [], [1.0] * (dim - 4), [1.0] * (dim - 1)]
    out += [(1000 + i, v, None, "c", 1, 2) for i, v in enumerate(bad)]
    return out + [out[7], out[7], (None, out[9][1], None, None, None, None), (-3, [-0.001] * dim, 1, "c", 1, 2)]


def expected(rows, entries, rounds, parts=4, dim=8):
    good = sorted((r for r in rows if r[1] is not None and len(r[1]) == dim and all(v is not None and np.isfinite(v) for v in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in good], np.float32).astype(float) * 1024).astype(int).astype(object)
    cut = np.split(x, parts, axis=1)
    books = [c[:entries].copy() for c in cut]
    for _ in range(rounds):
        for c, book in zip(cut, books):
            at = np.array(plain(c, book)[0])
            for j in set(at.tolist()):
                book[j] = [int(v) // int((at == j).sum()) for v in c[at == j].sum(axis=0)]
    found = [plain(c, b) for c, b in zip(cut, books)]
    codes = ["".join(f"{a[0][i]:02x}" for a in found) for i in range(len(good))]
    return books, sorted(zip([str(r[0]) for r in good], codes, [sum(a[1][i] for a in found) for i in range(len(good))]))


@pytest.mark.parametrize("entries,rounds", [(16, 4), (256, 2), (1, 1)])
def test_codes_are_those_of_a_plain_run(spark, entries, rounds):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    books = vector_codes.fit(df, entries=entries, rounds=rounds)
    want_books, want = expected(rows, entries, rounds)
    assert [b.tolist() for b in books] == [b.tolist() for b in want_books]
    done = vector_codes.encode(df, books)
    assert done.columns == ["vec_id", "embedding", "label", "row", "found", "code", "error"]
    got = done.collect()
    assert len(got) == len(rows) and sum(r["code"] is None for r in got) == 7
    assert all(r["row"] in (1, None) and r["found"] in (2, None) for r in got)
    assert sorted((str(r["vec_id"]), r["code"], r["error"]) for r in got if r["code"] is not None) == want


def test_large_components_stay_exact(spark):
    rows = [(i, [float(s * 2.0**k) for k in (20, 24, 3, 30)], 1, "", 1, 1) for i, s in enumerate([1, -1, 3, 1.5])]
    df = spark.createDataFrame(rows, SCHEMA)
    books = vector_codes.fit(df, entries=2, rounds=1)
    want_books, want = expected(rows, 2, 1, dim=4)
    assert [b.tolist() for b in books] == [b.tolist() for b in want_books]
    got = [(str(r["vec_id"]), r["code"], r["error"]) for r in vector_codes.encode(df, books).collect()]
    assert sorted(got) == [(a, b, e if e < 2**63 else None) for a, b, e in want]


def test_no_usable_vector(spark):
    for rows in ([], [(1, None, 1, "", 1, 1)]):
        df = spark.createDataFrame(rows, SCHEMA)
        books = vector_codes.fit(df)
        assert books == [] and [r["code"] for r in vector_codes.encode(df, books).collect()] == [None] * len(rows)
    assert vector_codes.books_sha256([]) == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_heavy_and_light_keys_meet_alike(spark):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([None] * 40 + ["a"] * 3000 + [f"k{j}" for j in range(2000)])], "key string, i long")
    side = rows.groupBy("key").count().selectExpr("key", "count as n", "count * 10 as found")
    got = join_by_weight(rows, side, "key", "n").collect()
    assert len(got) == rows.count() and {(r["key"], r["found"]) for r in got if r["key"] in (None, "a", "k7")} == {(None, 400), ("a", 30000), ("k7", 10)}
    none = rows.where("false")
    assert join_by_weight(none, side.where("false"), "key", "n").count() == 0
