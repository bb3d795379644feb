"""Language of a text by a string kernel: blended n-gram presence, Nyström landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the share of character n-grams (n = 1..``SPAN``, each counted once, hashed to ``BUCKETS`` places) they have in
common: ``|A & B| / sqrt(|A| |B|)``. Landmarks are part of the training texts; ``K(x, landmarks) K(landmarks, landmarks)^(-1/2)`` are the
features, and a ridge regression per language, +1 against -1, gives the scores. A batch of texts is scored by two matrix products.

Only the fit is bounded: at most ``per_language`` labelled rows of a language, those of the smallest row hash, and at most
``landmarks_per_language`` landmarks among them. Prediction reads every row's whole text and nothing but its text.
Null texts and texts without a letter are ``und`` with score 0; without any labelled row every text is ``und``. Languages that tie
go to the first in order of name. Repeated rows get the same answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN = 4
BUCKETS = 1 << 15
PER_LANGUAGE = 300
LANDMARKS_PER_LANGUAGE = 48
LANGUAGES = 256
PARTS = 64  # parts of a language that are thinned out side by side
RIDGE = 1e-2
ROWS = 64  # texts in one matrix product
COLUMNS = 4096  # buckets in one product of landmarks
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _places(text: str) -> np.ndarray:
    """The buckets of all n-grams of a text, repeats included."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    gram, out = np.zeros(len(codes), np.uint32), []
    for n in range(1, SPAN + 1):
        if len(codes) < n:
            break
        gram = gram[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
        out.append((gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def presence(texts: list[str]) -> np.ndarray:
    """One row per text, scaled to length one, so that products of rows are kernel values."""
    rows = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(rows, texts):
        row[_places(text)] = 1.0
    size = rows.sum(axis=1, keepdims=True)
    rows /= np.sqrt(np.maximum(size, 1.0))
    return rows


def fit_texts(texts: list[str], langs: list[str], landmarks_per_language: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> dict | None:
    """Landmark rows and the matrix from their kernel values to a score per language."""
    names = sorted(set(langs))
    if not names:
        return None
    labels = np.array(langs)
    chosen = np.concatenate([np.flatnonzero(labels == n)[:landmarks_per_language] for n in names])
    marks = np.ascontiguousarray(presence([texts[k] for k in chosen]).T)
    inner = np.zeros((len(chosen), len(chosen)))
    for start in range(0, BUCKETS, COLUMNS):
        part = marks[start : start + COLUMNS].astype(np.float64)
        inner += part.T @ part
    values, vectors = np.linalg.eigh(inner)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    # a few texts at a time: a row per text is 128 kB, and all of them would be the most that the driver ever holds
    kernel = np.concatenate([presence(texts[k : k + ROWS]) @ marks for k in range(0, len(texts), ROWS)]).astype(np.float64) @ root
    features = np.hstack([kernel, np.ones((len(kernel), 1))])
    target = np.where(labels[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = 1.0 / np.array([np.sum(labels == n) for n in labels])[:, None]  # every language weighs the same
    gram = features.T @ (features * weight) + ridge * len(names) * np.eye(features.shape[1]) / features.shape[1]
    solved = np.linalg.solve(gram, features.T @ (target * weight))
    return {"names": names, "marks": marks, "map": (root @ solved[:-1]).astype(np.float32), "bias": solved[-1].astype(np.float32)}


def score_texts(model: dict | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language, score from 0 to 1 (0.5 where the classifier is undecided) of each text."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [k for k, t in enumerate(texts) if has_letter(t)] if model else []
    for start in range(0, len(known), ROWS):
        part = known[start : start + ROWS]
        values = (presence([texts[k] for k in part]) @ model["marks"]) @ model["map"] + model["bias"]
        best = values.argmax(axis=1)
        for k, b, v in zip(part, best, values[np.arange(len(part)), best]):
            langs[k], scores[k] = model["names"][b], float(np.clip((v + 1.0) / 2.0, 0.0, 1.0))
    return langs, scores


def fit(docs: DataFrame, train, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> dict | None:
    """Fit on rows where ``train`` holds. What reaches the driver is at most ``LANGUAGES`` x ``per_language`` texts."""
    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    keyed = rows.select("lang", F.xxhash64("text").alias("h"))
    picked = keyed.distinct()
    for part in (["lang", F.pmod("h", F.lit(PARTS))], ["lang"]):  # the smallest of parts first, so that no task holds a whole language
        order = Window.partitionBy(*part).orderBy("h")
        picked = picked.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).drop("n")
    total = picked.agg(F.countDistinct("lang")).first()[0]
    if total > LANGUAGES:
        raise ValueError(f"{total} languages; at most {LANGUAGES} are fitted")
    chosen = picked.select("lang", "h")
    found = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    pairs = sorted((r["lang"], r["h"], r["text"]) for r in found.collect())
    return fit_texts([t for _, _, t in pairs], [x for x, _, _ in pairs])


def predict(docs: DataFrame, model: dict | None, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def run(texts: pa.Array) -> pa.Array:
        # the texts of a batch become Python's a few at a time
        parts = [score_texts(shared.value, texts.slice(k, ROWS).to_pylist()) for k in range(0, len(texts), ROWS)]
        langs, scores = [x for part, _ in parts for x in part], [x for _, part in parts for x in part]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    df = docs.withColumn("_language", run(F.col(text)))
    return df.withColumns({out: F.col("_language.lang"), score: F.col("_language.score")}).drop("_language")
