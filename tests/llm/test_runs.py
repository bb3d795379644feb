"""Periodic runs against a look at every period of every text."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from quarterdeck.llm import queries, runs


def plain(words):
    """Runs by every period; the smallest period of each stretch."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, k = rng.choice([0, 1, 5, 6, 7, rng.randint(0, 60), rng.randint(0, 300)]), rng.choice([1, 2, 3, 50])
    words = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        for i in range(a, rng.randint(a, n)):
            words[i] = words[a + (i - a) % p]
    return words


def test_transform_gives_exact_sums():
    rng = np.random.default_rng(2)
    for size in (1, 2, 8, 64):
        b, w = rng.integers(0, 1 << 20, (5, size)), rng.integers(0, 1 << 20, (5, 2 * size))
        want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(b[r], w[r, j : j + size])) % runs.PRIME for j in range(size + 1)] for r in range(5)]
        assert runs.mismatches(b, w).tolist() == want
        x = rng.integers(0, runs.PRIME, (3, 2 * size)).astype(np.uint64)
        assert runs.inverse(runs.transform(x)).tolist() == x.tolist()


def test_runs_of_many_texts():
    rng = random.Random(5)
    for _ in range(150):
        texts = [some_words(rng) for _ in range(rng.randint(1, 8))]
        assert runs.periodic_runs(texts) == [plain(t) for t in texts]


def test_long_runs_in_a_long_text():
    rng = random.Random(6)
    words = [rng.randrange(500) for _ in range(30_000)]
    period = [rng.randrange(1000) for _ in range(3001)]
    words[9000:23_000] = [period[i % 3001] for i in range(14_000)]
    words[200:4000] = [7] * 3800
    words[4500:5500] = [1, 2] * 500
    got = runs.periodic_runs([words])[0]
    assert {q for _, _, q in got} >= {3001, 1, 2} and len(got) == 3
    for start, length, q in got:
        assert all(words[i] == words[i + q] for i in range(start, start + length - q)) and length >= 4 * q
        assert words[start - 1] != words[start - 1 + q] and words[start + length] != words[start + length - q]


TEXTS = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "x a b a b a b a b\ty", "a  b a\nb a b a b", "é é é é é é é é é é é é", "1 2 3 " * 2000, "b b b b b b a a a a a a", "ab " * 7 + "ab"]


def expected(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = plain(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return found, " ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows_of_a_table(spark):
    texts = TEXTS + TEXTS[4:9]
    docs = spark.createDataFrame([(i, t, "w", 5) for i, t in enumerate(texts)], "doc_id long, text string, found string, runs int")
    done = runs.with_runs(docs)
    assert done.columns == ["doc_id", "text", "found", "runs"]
    for r in done.collect():
        want = expected(texts[r["doc_id"]])
        assert ([tuple(x) for x in r["found"]["runs"]], r["found"]["collapsed"], r["runs"]) == (*want, 5)
    assert runs.with_runs(docs.where("false")).count() == 0


def test_query_rows(spark, tmp_path):
    rng = random.Random(8)
    texts = TEXTS + [" ".join(f"w{x}" for x in some_words(rng)) for _ in range(150)]
    spark.createDataFrame(list(enumerate(texts)) + [(None, "a " * 8)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r.asDict() for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts) + 1 and got[None]["n_runs"] == 1
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        found, kept = expected(" ".join(words))
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        told = "".join(f"{s},{x},{q}\n" for s, x, q in found)
        want = [i, len(found), best[0], best[1], best[2], found and 1000 * best[1] // best[2] or None, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()]
        assert list(got[i].values()) == want


def test_planted_texts_are_split_once(spark, sf):
    """The words are an array of their own before the lambda looks into it."""
    plan = queries.with_planted_runs(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
