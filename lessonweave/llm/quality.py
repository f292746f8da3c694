"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters slide over the
embedded bytes of each chunk and are max-pooled over it; the mean and the maximum over a document's chunks
go through one logistic unit, which gives the probability of label 1.

The network is trained on the driver on a bounded sample of labelled rows (``sample_rows`` rows with the
smallest hashes of their ids, texts of up to ``sample_chars`` characters); scoring covers every whole text
where it is, without a shuffle.

Defined cases: a row without a doc_id is not held out, and not learned from, as no label is its own; where a
document has both labels, the larger counts; null and empty texts are one chunk of padding and get its score; repeated rows get equal
scores; labels without a document, and null labels, are not learned from; without both labels in the
sample, every score is the share of label 1 in it (0.5 if there is no label at all).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.common import flat_text, mapped, spans_of_rows

CHUNK, WIDTH, HOP = 252, 12, 6
STEP = CHUNK - WIDTH
WINDOWS = (CHUNK - WIDTH) // HOP + 1
DIM, FILTERS = 6, 24
THRESHOLD = 0.3


@dataclass
class Network:
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # WIDTH * DIM x FILTERS
    bias: np.ndarray
    mean_w: np.ndarray
    max_w: np.ndarray
    offset: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.mean_w, self.max_w, self.offset]


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping chunks of all rows, zero-padded, and the row of each."""
    row, at, left = _places(offsets)
    return _cut(data, at, left), row


def _places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and size of each chunk."""
    size = np.diff(offsets)
    n = np.maximum(1, -(-(size - WIDTH) // STEP))
    row = np.repeat(np.arange(len(size)), n)
    at = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * STEP
    return row, offsets[:-1][row] + at, np.minimum(size[row] - at, CHUNK)


def _cut(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    x = np.zeros((len(at), CHUNK), np.uint8)
    for lo in range(0, len(at) if len(data) else 0, 1024):  # the indices take more room than the chunks
        index = np.minimum(at[lo : lo + 1024, None] + np.arange(CHUNK), len(data) - 1)
        np.copyto(x[lo : lo + 1024], data[index], where=np.arange(CHUNK) < left[lo : lo + 1024, None])
    return x


def _columns(net: Network, x: np.ndarray) -> np.ndarray:
    e = net.embed[x]
    s0, s1, s2 = e.strides
    view = np.lib.stride_tricks.as_strided(e, (len(x), WINDOWS, WIDTH * DIM), (s0, HOP * s1, s2))
    return np.ascontiguousarray(view)


def pooled(net: Network, x: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), FILTERS), np.float32)
    for lo in range(0, len(x), 256):
        z = _columns(net, x[lo : lo + 256]).reshape(-1, WIDTH * DIM) @ net.filters
        out[lo : lo + 256] = z.reshape(-1, WINDOWS, FILTERS).max(axis=1)
    return np.maximum(out + net.bias, 0)


def score_rows(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    row, at, left = _places(offsets)
    p = np.concatenate([pooled(net, _cut(data, at[lo : lo + 4096], left[lo : lo + 4096])) for lo in range(0, len(at), 4096)])
    first = np.flatnonzero(np.diff(row, prepend=-1))
    mean = np.add.reduceat(p, first, axis=0) / np.diff(np.append(first, len(row)))[:, None]
    most = np.maximum.reduceat(p, first, axis=0)
    return _sigmoid(mean @ net.mean_w + most @ net.max_w + net.offset[0])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[str], labels: list[int], steps: int = 500, batch: int = 48, chunks_per_text: int = 16, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    f32 = np.float32
    net = Network(
        rng.normal(0, 0.5, (256, DIM)).astype(f32), rng.normal(0, (2 / (WIDTH * DIM)) ** 0.5, (WIDTH * DIM, FILTERS)).astype(f32),
        np.zeros(FILTERS, f32), rng.normal(0, 0.1, FILTERS).astype(f32), np.zeros(FILTERS, f32), np.zeros(1, f32),
    )
    net.embed[0] = 0
    y = np.array(labels, f32)
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        net.mean_w[:] = 0
        share = min(max(share, 1e-6), 1 - 1e-6)
        net.offset[0] = np.log(share / (1 - share))
        return net
    net.offset[0] = np.log(share / (1 - share))
    data, offsets = flat_text(pa.array(texts))
    x, row = chunks(data, offsets)
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    order = np.empty(0, np.int64)
    for t in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(texts))])
        docs, order = order[:batch], order[batch:]
        own = [np.arange(first[d], first[d + 1]) for d in docs]
        own = [o if len(o) <= chunks_per_text else rng.choice(o, chunks_per_text, replace=False) for o in own]
        n = np.array([len(o) for o in own])
        grads = _gradients(net, x[np.concatenate(own)], np.repeat(np.arange(len(docs)), n), n, y[docs])
        rate = 0.01 * min(1, t / 20) * (1 - 0.9 * t / steps)
        for p, g, (m, v) in zip(net.parts(), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        net.embed[0] = 0
    return net


def _gradients(net: Network, x: np.ndarray, doc: np.ndarray, n: np.ndarray, y: np.ndarray, decay: float = 1e-4) -> list[np.ndarray]:
    cols = _columns(net, x)
    z = cols @ net.filters + net.bias
    arg = z.argmax(axis=1)
    p = np.take_along_axis(z, arg[:, None, :], 1)[:, 0]
    live = p > 0
    p = np.where(live, p, 0)
    first = np.cumsum(n) - n
    mean = np.add.reduceat(p, first, axis=0) / n[:, None]
    most = np.maximum.reduceat(p, first, axis=0)
    d = ((_sigmoid(mean @ net.mean_w + most @ net.max_w + net.offset[0]) - y) / len(y)).astype(np.float32)
    dp = (d / n)[doc][:, None] * net.mean_w
    top = p == most[doc]
    top &= np.cumsum(top, axis=0) - (np.cumsum(top, axis=0) - top)[first][doc] == 1  # the first of equal maxima
    dp = (dp + top * d[doc][:, None] * net.max_w) * live
    rows = np.arange(len(x))[:, None]
    chosen = cols[rows, arg]  # chunk x filter x WIDTH * DIM
    g_filters = np.einsum("nf,nfk->kf", dp, chosen, optimize=True)
    g_cols = (dp[:, :, None] * net.filters.T).reshape(-1, DIM)
    at = x[rows[:, :, None], arg[:, :, None] * HOP + np.arange(WIDTH)].ravel()
    g_embed = np.stack([np.bincount(at, g_cols[:, j], 256) for j in range(DIM)], axis=1).astype(np.float32)
    out = [g_embed, g_filters, dp.sum(axis=0), d @ mean, d @ most, d.sum(keepdims=True)]
    return [g + decay * w for g, w in zip(out, net.parts(), strict=True)]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(documents: DataFrame, labels: DataFrame, sample_rows: int = 4000, sample_chars: int = 65536) -> Network:
    """Learn ``labels.quality`` from a bounded sample of the rows that are not held out."""
    ids = labels.where(~held_out() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("__label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("__text")).join(F.broadcast(ids), "doc_id")
    rows = rows.where(F.length("__text") <= sample_chars).groupBy("doc_id").agg(F.min("__text").alias("__text"), F.max("__label").alias("__label"))
    found = sorted((r for r in rows.collect()), key=lambda r: r[0])
    return train([r["__text"] for r in found], [r["__label"] for r in found])


def score_quality(documents: DataFrame, net: Network, text: str = "text", name: str = "__score") -> DataFrame:
    """All columns of ``documents`` and the score."""
    shared = documents.sparkSession.sparkContext.broadcast(net)
    names = documents.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat_text(batch.column(names.index(text)))
        scores = [score_rows(shared.value, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in spans_of_rows(offsets, 1 << 20)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores), pa.float64())], names=[*names, name])

    schema = documents.withColumn(name, F.lit(0.0)).schema
    return mapped(documents, run, schema)


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is at least ``threshold``, with their own columns."""
    scored = score_quality(documents, fit_quality(documents, labels), name="__score")
    return scored.where(F.col("__score") >= threshold).drop("__score")


def op4_quality(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit_quality(docs, table(spark, sf_dir, "labels"))
    score = F.col("__score")
    return score_quality(docs, net).select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
