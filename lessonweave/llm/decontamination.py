"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The windows of all benchmark items are the patterns, a word is the symbol and two words make a block.
A shift table tells for each block how far the search may jump; where it tells 0, the bucket of the
window's suffix block gives the test strings and their bytes are compared. Many stretches of text are
searched in step, so that each step is one numpy operation.

Documents are only read, never shuffled. The patterns are broadcast; a benchmark beyond ``block_windows``
windows is cut into blocks below that number, one after the other, with what has been hit so far carried along with
each document, so that each broadcast stays bounded.

Defined cases: a null or empty text has no words; an item with a null id or no words is left out; items
that share an id count once; repeated documents each get their row; an empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.bytewords import find_words, hash_windows, hash_words
from lessonweave.llm.common import durable, flat_text, mapped, spans_of_rows

WINDOW = 10
_LANE = 512


class Patterns:
    """Windows of one length, with the tables of the search."""

    def __init__(self, length: int, windows: dict[bytes, list[int]]):
        self.length, self.block = length, min(2, length)
        texts = list(windows)
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        h = hash_words(find_words(data, offsets)).reshape(len(texts), length)
        keys = np.concatenate([hash_windows(row, length) for row in h])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.texts = [np.frombuffer(texts[i], np.uint8) for i in order]
        self.items = [windows[texts[i]] for i in order]
        blocks = [hash_windows(row, self.block) for row in h]
        self.bits = np.uint64(64 - max(12, min(24, int(len(texts) * length * 64).bit_length())))
        most = length - self.block + 1
        self.shift = np.full(1 << (64 - int(self.bits)), most, np.uint8)
        for j in range(most):
            at = np.array([b[j] for b in blocks]) >> self.bits
            np.minimum.at(self.shift, at.astype(np.int64), most - 1 - j)

    def search(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of each window that may occur."""
        m, n = self.length, len(h)
        if n < m:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        blocks = hash_windows(h, self.block)  # block ending at word i is blocks[i - block + 1]
        back = self.block - 1
        pos = np.arange(m - 1, n, _LANE)
        stop = np.minimum(pos + _LANE, n)
        found = []
        while len(pos):
            s = self.shift[(blocks[pos - back] >> self.bits).astype(np.int64)]
            if not s.all():
                found.append(pos[s == 0])
            pos = pos + np.maximum(s, 1)
            keep = pos < stop
            if not keep.all():
                pos, stop = pos[keep], stop[keep]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        first = np.concatenate(found) - m + 1
        first = first[doc[first] == doc[first + m - 1]]
        rows = np.stack([h[first + j] for j in range(m)], axis=1) if len(first) else np.empty((0, m), np.uint64)
        keys = _hash_rows(rows)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = self.keys[at] == keys
        return first[same], at[same]


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    """hash_windows of each row as a whole."""
    if not len(rows):
        return np.empty(0, np.uint64)
    from lessonweave.llm.bytewords import _BASE, mix

    with np.errstate(over="ignore"):
        out = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            out = out * np.uint64(_BASE) + rows[:, j]
    return mix(out)


def build_patterns(items: list[tuple[object, str]], window: int = WINDOW) -> tuple[list[Patterns], list[str]]:
    """Search tables by window length, and the ids of the items, sorted as strings."""
    names = sorted({str(k) for k, _ in items})
    number = {k: i for i, k in enumerate(names)}
    by_length: dict[int, dict[bytes, list[int]]] = {}
    for k, text in items:
        data, offsets = flat_text(pa.array([text]))
        w = find_words(data, offsets)
        words = [w.low[a:b].tobytes() for a, b in zip(w.start, w.end, strict=True)]
        if not words:
            continue
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            owners = by_length.setdefault(size, {}).setdefault(b" ".join(words[i : i + size]), [])
            if number[str(k)] not in owners:
                owners.append(number[str(k)])
    return [Patterns(n, w) for n, w in sorted(by_length.items())], names


def find_hits(data: np.ndarray, offsets: np.ndarray, patterns: list[Patterns]):
    """Words by row, which of all words are hit, and the (row, item) pairs that occur."""
    w = find_words(data, offsets)
    n = len(w.start)
    change = np.zeros(n + 1, np.int64)
    pairs: set[tuple[int, int]] = set()
    if n:
        h = hash_words(w)
        # Words of a row with one space between them: a window's bytes then are one slice.
        size = w.end - w.start
        put = np.concatenate([[0], np.cumsum(size + 1)])
        joined = None
        for p in patterns:
            first, which = p.search(h, w.doc)
            if not len(first):
                continue
            if joined is None:
                joined = np.full(put[-1], 32, np.uint8)
                joined[np.arange(int(size.sum())) + np.repeat(np.arange(n), size)] = w.low[w.mask]
            for k in np.unique(which):
                at, text = first[which == k], p.texts[k]
                at = at[put[at + p.length] - 1 - put[at] == len(text)]
                for lo in range(0, len(at), 4096):
                    part = at[lo : lo + 4096]
                    same = (joined[put[part][:, None] + np.arange(len(text))] == text).all(axis=1)
                    part = part[same]
                    np.add.at(change, part, 1)
                    np.add.at(change, part + p.length, -1)
                    pairs.update((int(d), i) for d in np.unique(w.doc[part]) for i in p.items[k])
    return w, np.cumsum(change[:-1]) > 0, pairs


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_windows: int = 200_000) -> DataFrame:
    """All columns of ``documents`` and ``__n_words``, ``__n_hit`` (long), ``__items`` (array of item ids as
    strings, sorted)."""
    bench = benchmark.select(F.col("item_id").cast("string").alias("k"), F.col("text").alias("t")).where("k IS NOT NULL AND t IS NOT NULL")
    words = F.regexp_count("t", F.lit(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"))  # no item has more windows than words
    size = bench.agg(F.coalesce(F.sum(words), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // block_windows))
    kept = documents.columns
    out = documents.withColumns({"__bits": F.lit(None).cast("binary"), "__n_words": F.lit(0).cast("long"), "__n_hit": F.lit(0).cast("long"), "__items": F.array().cast("array<string>")})
    for b in range(n_blocks):
        block = bench.where(F.pmod(F.xxhash64("k", "t"), F.lit(n_blocks)) == b) if n_blocks > 1 else bench
        out = _search_block(out, [tuple(r) for r in block.collect()], text, window, last=b == n_blocks - 1)
        if b < n_blocks - 1:
            out = durable(out)
    return out.select(*kept, "__n_words", "__n_hit", "__items")


def _search_block(df: DataFrame, items: list[tuple], text: str, window: int, last: bool) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(build_patterns(items, window))
    names = df.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        patterns, ids = shared.value
        data, offsets = flat_text(batch.column(names.index(text)))
        before, items_before = batch.column(names.index("__bits")), batch.column(names.index("__items"))
        n_words, n_hit, found, bits = [], [], [], []
        for lo, hi in spans_of_rows(offsets, 1 << 20):
            w, hit, pairs = find_hits(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], patterns)
            counts = w.counts()
            ends = np.cumsum(counts)
            for r in range(lo, hi):
                if not last or before[r].is_valid:
                    own = hit[ends[r - lo] - counts[r - lo] : ends[r - lo]]
                    if before[r].is_valid:
                        own = own | np.unpackbits(np.frombuffer(before[r].as_py(), np.uint8), count=len(own)).view(bool)
                    hit[ends[r - lo] - counts[r - lo] : ends[r - lo]] = own
                    bits.append(None if last else np.packbits(own).tobytes())
                else:
                    bits.append(None)
            n_words.append(counts)
            n_hit.append(np.bincount(w.doc[hit], minlength=hi - lo))
            own: dict[int, list[str]] = {}
            for d, i in sorted(pairs):
                own.setdefault(d, []).append(ids[i])
            for r in range(lo, hi):
                old = items_before[r].as_py() or []
                found.append(sorted({*old, *own.get(r - lo, [])}) if old else own.get(r - lo, []))
        new = {"__bits": pa.array(bits, pa.binary()), "__n_words": pa.array(np.concatenate(n_words), pa.int64()), "__n_hit": pa.array(np.concatenate(n_hit), pa.int64()), "__items": pa.array(found, pa.list_(pa.string()))}
        return pa.RecordBatch.from_arrays([new.get(n, c) for n, c in zip(names, batch.columns, strict=True)], names=names)

    return mapped(df, run, df.schema)


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.col("__n_hit") > 0).alias("contaminated"),
    )


#: Windows of ten words by brute force: each document window is joined to the items' windows.
OP9_SQL = r"""
WITH lowered AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS win
  FROM items, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS g(p)
  WHERE len(w) > 0
), sizes AS (SELECT DISTINCT m FROM item_windows),
doc_windows AS (
  SELECT rid, m, p, array_to_string(w[p : p + m - 1], ' ') AS win
  FROM lowered, sizes, unnest(generate_series(1, len(w) - m + 1)) AS g(p)
  WHERE len(w) >= m
), found AS (
  SELECT d.rid, d.p, d.m, i.item_id FROM doc_windows d JOIN item_windows i ON d.m = i.m AND d.win = i.win
), hits AS (
  SELECT rid, count(DISTINCT q) AS n_hit
  FROM (SELECT DISTINCT rid, p, m FROM found) f, unnest(generate_series(p, p + m - 1)) AS g(q) GROUP BY rid
), ids AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT rid, item_id FROM found) x GROUP BY rid
)
SELECT l.doc_id, CAST(len(l.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM lowered l LEFT JOIN hits h USING (rid) LEFT JOIN ids i USING (rid)
"""
