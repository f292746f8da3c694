"""N-gram Jaccard join: MinHash banding, shuffle on band hashes, verification on full n-gram sets.

A document's set holds the 64-bit hashes of its five-word shingles (one shingle of all words where there are
fewer). Documents with equal sets are one class of copies and are never expanded. Two sets are linked if their
Jaccard similarity is at least 0.8. Band and row counts follow from the recall asked for at that
similarity. Sets that share a band hash are joined into candidate groups through the bucket's smallest
member, so a bucket costs as many edges as it has members. A candidate group is cut into blocks of bounded
size, of sets with the same least band hash where there are enough, so that similar sets are mostly in one block. Only
pairs of blocks with a band in common are compared, exactly, each in a task of its own, on whole sets, which gives the
number of links of each set and a spanning forest of the links. Neither step emits pairs of sets, and a set is copied
to the blocks that it may have a link to, not to all of its group.

Ids of sets are 64-bit hashes; two different sets get one id with a chance of 2**-64.

Defined cases: null, empty and wordless texts have no set, no links, and are a class of their own; the
copies of a document count as its links; rows with equal doc_id and text are copies too; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.bytewords import find_words, hash_windows, hash_words, mix
from lessonweave.llm.common import durable, flat_text, in_arrow, mapped, spans_of_rows
from lessonweave.llm.components import connected_components

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: A block of a candidate group holds about so many sets and shingles.
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 20
SMALL = 500_000


def choose_bands(threshold: float, recall: float, most_hashes: int = 192) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, with which a pair at the threshold
    still shares a band with the chance ``recall`` and there are at most ``most_hashes`` hashes."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' shingles, with repeats, in row order, and where each row's begin."""
    w = find_words(data, offsets)
    counts = w.counts()
    if not len(w.start):
        return np.empty(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    h = hash_words(w)
    row = w.doc
    long = hash_windows(h, size)
    keep = np.flatnonzero(row[: len(long)] == row[size - 1 :]) if len(long) else np.empty(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    first = np.cumsum(counts) - counts
    extra = np.array([hash_windows(h[first[r] : first[r] + counts[r]], int(counts[r]))[0] for r in short], np.uint64)
    rows, hashes = np.concatenate([row[keep], short]), np.concatenate([long[keep], extra])
    order = np.argsort(rows, kind="stable")
    return hashes[order], np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(counts)))])


def _signatures(hashes: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (rows x bands) of rows that have shingles."""
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
    c = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(starts), b + 1, np.uint64)
            for r in range(b * rows, (b + 1) * rows):
                v = (low ^ c[r]) * a[r]
                v ^= v >> np.uint32(15)
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(v, starts))
            out[:, b] = key
    return out


def signed_sets(documents: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc, key, set_id, n, bands) of each document; the last three are null without words."""
    docs = documents.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text"))
    schema = f"doc {docs.schema['doc'].dataType.simpleString()}, key bigint, set_id bigint, n int, bands array<bigint>"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat_text(batch.column(2))
        ids, sizes, signed = [], [], []
        for lo, hi in spans_of_rows(offsets, 2 << 20):
            hashes, first = shingle_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], size)
            own = np.flatnonzero(np.diff(first))
            sig = _signatures(hashes, first[own], bands, rows).view(np.int64) if len(own) else np.empty((0, bands), np.int64)
            at = dict(zip(own.tolist(), range(len(own)), strict=True))
            for r in range(hi - lo):
                if r in at:
                    members = np.unique(hashes[first[r] : first[r + 1]])
                    ids.append(int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True))
                    sizes.append(len(members))
                    signed.append(sig[at[r]])
                else:
                    ids.append(None)
                    sizes.append(None)
                    signed.append(None)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(signed, pa.list_(pa.int64()))], names=["doc", "key", "set_id", "n", "bands"])

    return mapped(docs, run, schema)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted sets without repeats."""
    n = len(sets)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column)
    use = often[column] > 1
    owner, column = owner[use], column[use]
    out = np.zeros((n, n), np.float32)
    if not len(owner):
        return out
    column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1
    cuts = np.searchsorted(column, np.arange(0, column[-1] + 1, 4096))
    for lo, hi in zip(cuts, [*cuts[1:], len(column)], strict=True):
        part = np.zeros((n, 4096), np.float32)
        part[owner[lo:hi], column[lo:hi] - column[lo]] = 1
        width = column[hi - 1] - column[lo] + 1
        out += part[:, :width] @ part[:, :width].T
    return out


def compare_blocks(ids: list[int], counts: list[int], sets: list[np.ndarray], side: list[bool] | None, threshold: float) -> list[tuple[int, int, int]]:
    """(id, documents linked, smallest id reached) of each set with a link. With ``side``, only pairs with
    one set on either side count."""
    size = np.array([len(s) for s in sets], np.float32)
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        shared = np.array([[0, both], [both, 0]], np.float32)
    else:
        shared = intersections(sets)
    linked = shared >= threshold * (size[:, None] + size - shared) - 1e-3
    np.fill_diagonal(linked, False)
    if side is not None:
        s = np.array(side)
        linked &= s[:, None] != s
    weight = linked @ np.array(counts, np.int64)
    root = np.arange(len(ids))
    order = np.array(ids, np.int64)
    least = order.copy()
    # Smallest id over links, again and again, until nothing changes.
    while True:
        reach = np.where(linked, least, np.iinfo(np.int64).max).min(axis=1) if len(ids) else least
        new = np.minimum(least, reach)
        if (new == least).all():
            break
        least = new
    return [(ids[i], int(weight[i]), int(least[i])) for i in root if weight[i]]


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows (root, i, j, block, id, n_docs, members) sorted by (root, i, j) within partitions."""

    def groups(batches: Iterator[pa.RecordBatch]):
        key, held = None, {}
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in range(6)]
            sets = batch.column(6)
            for r, (root, i, j, block, ident, docs) in enumerate(zip(*cols, strict=True)):
                if (root, i, j) != key:
                    if held:
                        yield key, held
                    key, held = (root, i, j), {}
                held[ident] = (block, docs, np.frombuffer(sets[r].as_py(), np.uint64))
        if held:
            yield key, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (_, i, j), held in groups(batches):
            if len(held) > 1:
                ids = sorted(held)
                side = None if i == j else [held[x][0] == i for x in ids]
                out += compare_blocks(ids, [held[x][1] for x in ids], [held[x][2] for x in ids], side, threshold)
            if len(out) > 20_000:
                yield _links(out)
                out = []
        if out:
            yield _links(out)

    return in_arrow(rows, run, "id bigint, links bigint, peer bigint")


def _links(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["id", "links", "peer"])


def _with_sets(docs: DataFrame, size: int) -> DataFrame:
    """Replace ``text``, the last column, by the document's sorted set as bytes."""
    names = [*docs.columns[:-1], "members"]
    schema = docs.drop("text").withColumn("members", F.lit(b"")).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat_text(batch.column(batch.num_columns - 1))
        sets = []
        for lo, hi in spans_of_rows(offsets, 2 << 20):
            hashes, first = shingle_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], size)
            sets += [np.unique(hashes[first[r] : first[r + 1]]).tobytes() for r in range(hi - lo)]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sets, pa.binary())], names=names)

    return mapped(docs, run, schema)


def _joined(large: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """``small`` is counted first, and broadcast only if it has few rows."""
    return large.join(F.broadcast(small) if small.count() <= SMALL else small, on, how)


def link_documents(documents: DataFrame, size_of_shingle: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc, key, set_id, links, root, first): one row per document; ``key`` is the hash of its text,
    ``links`` the number of other documents linked to it, ``root`` its connected group and ``first`` the
    group's first (doc, key, c), where c rows are equal to that one. Null ``root``: in no group."""
    bands, rows = choose_bands(threshold, recall)
    signed = durable(signed_sets(documents, size_of_shingle, bands, rows))
    copies = signed.where("set_id IS NOT NULL").groupBy("set_id", "doc", "key").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    sets = durable(copies.groupBy("set_id").agg(F.sum("c").alias("n_docs"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.min(F.struct("doc", "key", "c")).alias("first")))
    spread = sets.select(F.col("set_id").alias("id"), F.explode("bands").alias("band"))
    met = durable(spread.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("size")).where("size > 1"))
    crowded = _joined(spread, met.where("size > 2").select("band", "a"), "band").select("a", F.col("id").alias("b"))
    groups = connected_components(met.where("size = 2").select("a", "b").unionByName(crowded))
    members = groups.select(F.col("node").alias("set_id"), "root").join(sets, "set_id").withColumn("least", F.array_min("bands"))
    size = lambda own, shingles: F.ceil(F.greatest(own / BLOCK_SETS, shingles / BLOCK_SHINGLES)).cast("int")
    alike = members.groupBy("root", "least").agg(F.count(F.lit(1)).alias("own"), F.sum("n").alias("shingles"))
    alike = durable(alike.withColumn("parts", size(F.col("own"), F.col("shingles"))))
    weights = alike.where("parts = 1").groupBy("root").agg(size(F.sum("own"), F.sum("shingles")).alias("blocks"))
    # Many sets with one least band hash fill blocks of their own; the others share the group's.
    cut = alike.join(weights, "root", "left").select("root", "least", "parts", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("least"), F.col("blocks"))).alias("shared"))
    block = F.coalesce("shared", F.xxhash64("least", F.pmod(F.xxhash64("set_id"), F.col("parts"))))
    members = durable(members.join(cut, ["root", "least"]).select("set_id", "root", "n_docs", "first", "bands", block.alias("block")))
    there = members.select("root", "block", F.explode("bands").alias("band")).distinct()
    i, j = (there.select("root", F.col("block").alias(n), "band") for n in ("i", "j"))
    meet = i.join(j, ["root", "band"]).where("i < j").select("root", "i", "j").distinct()
    meet = durable(meet.unionByName(members.select("root", F.col("block").alias("i"), F.col("block").alias("j")).distinct()))
    wanted = members.select(F.col("first.doc").alias("doc"), F.col("first.key").alias("key"), "root", "block", F.col("set_id").alias("id"), "n_docs")
    docs = documents.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__key"), F.col("text").cast("string").alias("text"))
    texts = _joined(docs, wanted, F.col("__doc").eqNullSafe(F.col("doc")) & (F.col("__key") == F.col("key")))
    full = _with_sets(texts.select("root", "block", "id", "n_docs", "text"), size_of_shingle)
    sides = meet.select("root", F.col("i").alias("block"), "i", "j").unionByName(meet.where("i <> j").select("root", F.col("j").alias("block"), "i", "j"))
    dealt = _joined(full, sides, ["root", "block"]).select("root", "i", "j", "block", "id", "n_docs", "members")
    found = durable(_compare(dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j"), threshold))
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("peer").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = roots.withColumnRenamed("node", "id").join(links, "id", "left")
    grouped = sets.where("n_docs > 1").select(F.col("set_id").alias("id")).unionByName(linked.select("id")).distinct()
    grouped = grouped.join(linked, "id", "left").join(sets.select(F.col("set_id").alias("id"), "n_docs", "first"), "id")
    grouped = durable(grouped.select("id", F.coalesce("root", "id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("links"), "first"))
    firsts = grouped.groupBy("root").agg(F.min("first").alias("first"))
    grouped = durable(grouped.drop("first").join(firsts, "root"))
    # Documents without words have no group, and would all meet in one task.
    own = signed.select("doc", "key", "set_id")
    found = _joined(own.where("set_id IS NOT NULL"), grouped, F.col("set_id") == F.col("id"), "left").select("doc", "key", "set_id", "links", "root", "first")
    return found.unionByName(own.where("set_id IS NULL"), allowMissingColumns=True)


def keep_first(documents: DataFrame) -> DataFrame:
    """One document of each connected group, the first by doc_id, with its columns."""
    linked = durable(link_documents(documents).where("root IS NOT NULL"))
    is_first = F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("key") == F.col("first.key"))
    gone = durable(linked.where(~is_first).select(F.col("doc").alias("__doc"), F.col("key").alias("__key")).distinct())
    docs = documents.withColumn("__own", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__key"))
    left = _joined(docs, gone, same, "left_anti")
    # Rows that are equal in doc_id and text to a group's first document: one of them stays.
    repeated = durable(linked.where(is_first & (F.col("first.c") > 1)).select(F.col("doc").alias("__doc"), F.col("key").alias("__key")).distinct())
    if not repeated.isEmpty():
        again = _joined(left, repeated, same, "left_semi").dropDuplicates(["doc_id", "__own"])
        left = _joined(left, repeated, same, "left_anti").unionByName(again)
    return left.drop("__own")


def op5_jaccard(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    found = link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("doc").alias("doc_id"), F.when(F.col("root").isNull(), F.col("doc")).otherwise(F.col("first.doc")).alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"))


#: Exact similarities of all pairs that share a shingle, and components of the links.
OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[p : p + 4], ' ')) AS s
  FROM words, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS g(p) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE shared >= 0.8 * (p.n + q.n - shared) - 1e-9
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
)
SELECT d.doc_id, (SELECT min(r.y) FROM reach r WHERE r.x = d.doc_id) AS class_id,
       (SELECT count(*) FROM edges e WHERE e.x = d.doc_id) AS n_links
FROM documents d
"""
