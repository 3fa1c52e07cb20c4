"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Texts are lower-cased, everything but letters becomes a blank, and n-grams of one to three
characters are hashed into DIMENSIONS buckets. A text's vector is (1 + ln count) * idf, normalised.
Each language has several centroids from spherical k-means; a text gets the language of the centroid
of greatest cosine. It is marked as rejected when its distance is far beyond those of the training
texts of that centroid. Whole texts are read, in training as well as in prediction.

The model is fitted on a bounded sample: at most SAMPLE texts in all, and an equal share of them per
language, taken by the smallest hash of the text. Null texts and texts without a letter are ``und``
with score 0. With no training rows every text is. Ties go to the first centroid in order of names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wikiloom.llm.arrow import per_row

DIMENSIONS = 1 << 14
CENTROIDS = 3
SAMPLE = 2400
ROUNDS = 12
REJECT_DEVIATIONS = 6.0
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a text and their counts; empty without a letter."""
    words = _NOT_LETTERS.sub(" ", text).strip(" ").lower() if text else ""
    if not any(map(str.isalpha, set(words))):
        return np.empty(0, dtype=np.int64), np.empty(0)
    c = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found = []
    for n in (1, 2, 3):
        h = np.full(len(c) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = (h ^ c[i : len(c) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        found.append(h & np.uint64(DIMENSIONS - 1))
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=DIMENSIONS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets].astype(float)


@dataclass
class Model:
    """idf per bucket; centroids as columns, their languages, and least cosines accepted."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray

    def vector(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1 + np.log(counts)) * self.idf[buckets]
        return v / np.linalg.norm(v)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        buckets, counts = ngram_counts(text)
        if not len(buckets) or not self.languages:
            return UNKNOWN, 0.0, not self.languages
        cosine = self.vector(buckets, counts) @ self.centroids[buckets]
        best = int(np.argmax(cosine))
        score = float(min(1.0, max(0.0, cosine[best])))
        return self.languages[best], score, bool(cosine[best] < self.least[best])


def _clusters(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-point starts: centroids and the cluster of each vector."""
    starts = [0]
    nearest = vectors @ vectors[0]
    while len(starts) < min(k, len(vectors)):
        starts.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[starts[-1]])
    centroids = vectors[starts]
    for _ in range(ROUNDS):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([
            vectors[own == j].sum(axis=0) if (own == j).any() else centroids[j]
            for j in range(len(centroids))
        ])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def sample_rows(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """At most SAMPLE rows of text and language, as evenly over languages as there are rows."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    sizes = sizes.limit(SAMPLE).collect()
    if not sizes:
        return rows.limit(0)
    share = max(1, SAMPLE // len(sizes))
    # Twice the share by a bound on the hash, then the exact share among those few.
    bound = rows.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 2 * share / r["n"] + 20 / r["n"])) for r in sizes], "lang string, part double"
    )
    place = F.xxhash64("text").bitwiseAND(F.lit((1 << 52) - 1))
    few = rows.join(F.broadcast(bound), "lang").withColumn("place", place)
    few = few.where(F.col("place") < F.col("part") * float(1 << 52))
    order = Window.partitionBy("lang").orderBy("place", "text")
    return few.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= share).select("text", "lang")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Fit the model on the sample; tasks count the n-grams, the driver gets sparse vectors."""

    def make():
        def f(texts: list, batch: pa.RecordBatch) -> dict:
            found = [ngram_counts(t) for t in texts]
            return {
                "lang": batch.column("lang"),
                "buckets": [b.astype("<i4").tobytes() for b, _ in found],
                "counts": [c.astype("<f4").tobytes() for _, c in found],
            }

        return f

    sample = per_row(
        sample_rows(labelled, text, lang), "text", "lang string, buckets binary, counts binary", make
    ).collect()
    rows = sorted((r["lang"], r["buckets"], r["counts"]) for r in sample if r["buckets"])
    idf = np.ones(DIMENSIONS)
    model = Model(idf, np.empty((DIMENSIONS, 0)), [], np.empty(0))
    if not rows:
        return model
    sparse = [(np.frombuffer(b, "<i4"), np.frombuffer(c, "<f4").astype(float)) for _, b, c in rows]
    seen = np.zeros(DIMENSIONS)
    for buckets, _ in sparse:
        seen[buckets] += 1
    model.idf = np.log((1 + len(rows)) / (1 + seen)) + 1
    centroids, least = [], []
    for name in sorted({r[0] for r in rows}):
        own = [s for r, s in zip(rows, sparse) if r[0] == name]
        dense = np.zeros((len(own), DIMENSIONS), dtype=np.float32)
        for row, (buckets, counts) in zip(dense, own):
            row[buckets] = model.vector(buckets, counts)
        centres, cluster = _clusters(dense, CENTROIDS)
        for j, centre in enumerate(centres):
            cosine = dense[cluster == j] @ centre
            if len(cosine):
                centroids.append(centre)
                least.append(float(cosine.mean() - REJECT_DEVIATIONS * max(cosine.std(), 0.02)))
                model.languages.append(name)
    model.centroids = np.ascontiguousarray(np.stack(centroids, axis=1), dtype=np.float32)
    model.least = np.array(least)
    return model


def identify(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, lang_pred, score, rejected. Only the text is read."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def f(texts: list, batch: pa.RecordBatch) -> dict:
            found = [shared.value.predict(t) for t in texts]
            return {
                key: batch.column(key),
                "lang_pred": [r[0] for r in found],
                "score": [r[1] for r in found],
                "rejected": [r[2] for r in found],
            }

        return f

    rows = docs.select(key, F.col(text).cast("string").alias("_text"))
    return per_row(
        rows, "_text", f"`{key}` {kind}, lang_pred string, score double, rejected boolean", make
    )
