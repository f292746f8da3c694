"""Toxicity as a severity grade, by cumulative-link ordinal regression on sparse word features.

``P(grade > j) = sigmoid(w.x - t_j)`` for ordered thresholds ``t_1 < t_2 < t_3``; all thresholds share the
weights ``w``. The result is the expected severity, the sum of those probabilities, from 0 to 3.

Labels only tell toxic from not. Grade 0 is the label 0; rows with label 1 get grade 1, 2 or 3 by the
thirds of how often their text uses words that go with the label, so that severity follows the amount of
toxic wording. Features are log counts of the words that tell the labels apart (chi-square), found on the
sample; x is sparse, since most texts hold few of them.

The regression is fitted on the driver on a bounded sample of labelled rows (``sample_rows`` rows with the
smallest hashes of their ids, texts of up to ``sample_chars`` characters); scoring covers every whole text
where it is, without a shuffle.

Defined cases: null and empty texts have no words and so the lowest severity; repeated rows get equal
results; labels without a document, and null labels, are not learned from; without both labels in the
sample there are no features and each text gets severity 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.bytewords import find_words, hash_words
from lessonweave.llm.common import flat_text, mapped, spans_of_rows
from lessonweave.llm.quality import held_out

GRADES = 3
_FILTER_BITS = 18


@dataclass
class Severity:
    words: np.ndarray  # sorted 64-bit hashes of the features' words
    weight: np.ndarray
    thresholds: np.ndarray

    def __post_init__(self):
        self.known = np.zeros(1 << _FILTER_BITS, bool)
        self.known[(self.words >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, log count) of the features that occur."""
        w = find_words(data, offsets)
        h = hash_words(w)
        maybe = np.flatnonzero(self.known[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(maybe):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        at = np.minimum(np.searchsorted(self.words, h[maybe]), len(self.words) - 1)
        same = self.words[at] == h[maybe]
        key, count = np.unique(w.doc[maybe[same]] * len(self.words) + at[same], return_counts=True)
        return key // len(self.words), key % len(self.words), np.log1p(count)

    def exceed(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """P(grade > j) for j = 0, 1, 2, per row."""
        n = len(offsets) - 1
        if not len(self.words):
            return np.zeros((n, GRADES))
        row, feature, value = self.features(data, offsets)
        z = np.bincount(row, self.weight[feature] * value, n)
        return _sigmoid(z[:, None] - self.thresholds)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def train(texts: list[str], toxic: list[int], most_features: int = 2048, least_docs: int = 3, steps: int = 400, decay: float = 1e-4) -> Severity:
    y = np.array(toxic, np.int64)
    none = Severity(np.empty(0, np.uint64), np.empty(0), np.full(GRADES, 35.0))
    if not len(y) or y.min() == y.max():
        return none
    data, offsets = flat_text(pa.array(texts))
    w = find_words(data, offsets)
    words, at = np.unique(hash_words(w), return_inverse=True)
    key, count = np.unique(w.doc * len(words) + at, return_counts=True)
    row, col, value = key // len(words), key % len(words), np.log1p(count)
    n1, n0 = int(y.sum()), int((1 - y).sum())
    a, b = np.bincount(col, y[row], len(words)), np.bincount(col, 1 - y[row], len(words))
    odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
    n = n1 + n0
    chi = n * (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum((a + b) * (n - a - b) * n1 * n0, 1)
    chosen = np.flatnonzero((a + b >= least_docs) & (chi > 10.8))  # 1 in 1000 by chance
    chosen = chosen[np.argsort(-chi[chosen], kind="stable")][:most_features]
    chosen.sort()
    if not len(chosen):
        return none
    place = np.full(len(words), -1)
    place[chosen] = np.arange(len(chosen))
    use = place[col] >= 0
    row, col, value, odds = row[use], place[col[use]], value[use], odds[chosen]
    # Grades 1 to 3 by the thirds of toxic wording among the toxic.
    amount = np.bincount(row, np.expm1(value) * np.maximum(odds[col], 0), len(y))
    cuts = np.quantile(amount[y == 1], np.arange(1, GRADES) / GRADES)
    grade = np.where(y == 1, 1 + np.searchsorted(cuts, amount, side="left"), 0)
    above = (grade[:, None] > np.arange(GRADES)).astype(float)
    weight = np.zeros(len(chosen))
    base = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    first = -np.log(base / (1 - base))
    # The first threshold and the logs of the gaps, so that the thresholds stay in order.
    gaps = np.log(np.maximum(np.diff(first), 0.05))
    theta = np.concatenate([first[:1], gaps])
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (weight, theta)]
    for t in range(1, steps + 1):
        thresholds = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        z = np.bincount(row, weight[col] * value, len(y))
        # Cumulative-link likelihood of the observed grade: F(upper) - F(lower).
        f = _sigmoid(z[:, None] - thresholds)  # P(grade > j)
        full = np.concatenate([np.ones((len(y), 1)), f, np.zeros((len(y), 1))], axis=1)
        slope = full * (1 - full)
        i = np.arange(len(y))
        p = np.maximum(full[i, grade] - full[i, grade + 1], 1e-9)
        d_upper, d_lower = slope[i, grade] / p, slope[i, grade + 1] / p
        d_z = -(d_upper - d_lower) / len(y)
        d_t = np.zeros(GRADES + 2)
        np.add.at(d_t, grade, d_upper / len(y))
        np.add.at(d_t, grade + 1, -d_lower / len(y))
        d_t = d_t[1:-1]
        tail = np.cumsum(d_t[::-1])[::-1]
        grads = [np.bincount(col, d_z[row] * value, len(chosen)) + decay * weight, np.concatenate([tail[:1], tail[1:] * np.exp(theta[1:])])]
        rate = 0.1 * (1 - 0.9 * t / steps)
        for q, g, (m, v) in zip((weight, theta), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Severity(words[chosen], weight, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])])))


def fit_severity(documents: DataFrame, labels: DataFrame, sample_rows: int = 4000, sample_chars: int = 65536) -> Severity:
    """Learn ``labels.toxic`` from a bounded sample of the rows that are not held out."""
    ids = labels.where(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("__label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("__text")).join(F.broadcast(ids), "doc_id")
    rows = rows.where(F.length("__text") <= sample_chars).groupBy("doc_id").agg(F.min("__text").alias("__text"), F.max("__label").alias("__label"))
    found = sorted(rows.collect(), key=lambda r: r[0])
    return train([r["__text"] for r in found], [r["__label"] for r in found])


def grade_toxicity(documents: DataFrame, model: Severity, text: str = "text") -> DataFrame:
    """All columns of ``documents`` and ``__p_over_0``, ``__p_over_1``, ``__p_over_2``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = documents.columns
    new = [f"__p_over_{j}" for j in range(GRADES)]
    schema = documents.withColumns({n: F.lit(0.0) for n in new}).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat_text(batch.column(names.index(text)))
        p = np.concatenate([shared.value.exceed(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in spans_of_rows(offsets, 4 << 20)])
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, j].copy()) for j in range(GRADES))], names=[*names, *new])

    return mapped(documents, run, schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    graded = grade_toxicity(docs, fit_severity(docs, table(spark, sf_dir, "labels")))
    over = [F.col(f"__p_over_{j}") for j in range(GRADES)]
    return graded.select(
        "doc_id",
        (over[0] + over[1] + over[2]).alias("severity"),
        over[0].alias("p_toxic"),
        ((over[0] >= 0.5).cast("int") + (over[1] >= 0.5).cast("int") + (over[2] >= 0.5).cast("int")).alias("grade"),
        (over[0] >= 0.5).alias("toxic"),
    )
