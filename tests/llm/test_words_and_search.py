"""Decontamination, packing and top-k search against brute force."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lessonweave.llm import bytewords, decontamination, packing, topk
from lessonweave.llm.common import flat_text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def test_words_are_those_of_the_pattern():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aZ0 .é𝑈\n_-ÄIi") for _ in range(rng.randint(0, 60))) for _ in range(400)] + [None, ""]
    data, offsets = flat_text(pa.array(texts, pa.string()))
    w = bytewords.find_words(data, offsets)
    got = [[] for _ in texts]
    for d, a, b in zip(w.doc, w.start, w.end, strict=True):
        got[d].append(w.low[a:b].tobytes().decode())
    assert got == [words(t) for t in texts]
    seen = {}
    for h, (a, b) in zip(bytewords.hash_words(w), zip(w.start, w.end, strict=True), strict=True):
        assert seen.setdefault(w.low[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def brute_hits(text, items):
    ws, hit, ids = words(text), set(), set()
    for k, t in items:
        iw = words(t) if k is not None else []
        m = min(10, len(iw))
        wins = {tuple(iw[i : i + m]) for i in range(len(iw) - m + 1)} if m else set()
        for i in range(len(ws) - m + 1 if m else 0):
            if tuple(ws[i : i + m]) in wins:
                hit |= set(range(i, i + m))
                ids.add(str(k))
    return len(ws), len(hit), sorted(ids)


@pytest.mark.parametrize("block_windows", [1 << 20, 20])
def test_decontamination_is_exact(spark, block_windows):
    rng = random.Random(3)
    some = lambda n: " ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(n))
    items = [(i, some(rng.choice([0, 1, 3, 9, 10, 14]))) for i in range(12)] + [(None, "ab cd"), (50, None), (3, "zz"), (7, "Éa ÉA")]
    rows = [(i, some(rng.randint(0, 40)), 1.0) for i in range(60)] + [(5, "zz " * 3000, 0.0), (None, "éa Éa ÉA zz", 1.0), (60, None, 1.0), (61, "", 1.0), (61, "", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit double").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(docs, bench, block_windows=block_windows)
    assert got.columns[:3] == ["doc_id", "text", "n_hit"]
    out = [((r["doc_id"], r["text"]), (r["__n_words"], r["__n_hit"], r["__items"])) for r in got.collect()]
    assert len(out) == len(rows) and all(v == brute_hits(k[1], items) for k, v in out)
    assert {r["__n_hit"] for r in decontamination.decontaminate(docs, bench.limit(0)).collect()} == {0}
    assert decontamination.decontaminate(docs.limit(0), bench).count() == 0


def test_packing_places_every_id_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "of", "Ωmega", "x1", "\n\n", "<|endoftext|>"]) for _ in range(rng.randint(0, 900))) for _ in range(80)] + [None, "", "a" * 20_000, "same", "same"]
    docs = spark.createDataFrame([(i if i % 9 else None, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    pieces = packing.pack(docs).collect()
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(tuple([*full.encode(t or "", add_special_tokens=False).ids, 0]) for t in texts)
    by_window = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        by_window.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in by_window.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024
    docs_found = []
    for p in (p for p in pieces if p["start"] == 0):
        parts = sorted((q for q in pieces if q["doc_id"] == p["doc_id"] and q["doc_tokens"] == p["doc_tokens"] and (p["doc_id"] is not None or q is p)), key=lambda q: q["start"])
        if p["doc_id"] is not None and len({q["start"] for q in parts}) == len(parts):
            docs_found.append(tuple(np.frombuffer(b"".join(q["ids"] for q in parts), "<u4").tolist()))
    assert set(docs_found) <= set(want) and len(docs_found) > 60
    assert sum(p["length"] for p in pieces) == sum(map(len, want))
    row = packing.with_digest(packing.pack(spark.createDataFrame([(1, "same")], "doc_id long, text string"))).first()
    assert row["ids_crc32"] == zlib.crc32(np.array([*full.encode("same", add_special_tokens=False).ids, 0], "<u4").tobytes())
    assert packing.pack(docs.limit(0)).count() == 0


def test_best_fit_is_the_tightest():
    rng = random.Random(6)
    lengths = [rng.randint(1, 64) for _ in range(400)]
    placed, n, _ = packing.pack_lengths(lengths, 64, 0, [])
    room = []
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[k]]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - lengths[k])
        else:
            room.append(64 - lengths[k])
    assert n == len(room)
    left = [64] * n
    for (w, _), size in zip(placed, lengths, strict=True):
        left[w] -= size
    assert sorted(left) == sorted(room)


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(0, 0.2, (12, 16))
    vectors = [(i, [float(x) for x in base[i % 12] + rng.normal(0, 0.05, 16)]) for i in range(700)]
    vectors += [(700 + i, [0.25] * 16) for i in range(40)] + [(800, None), (801, [1.0, None] * 8), (850, [float("nan")] * 16), (900, [1.0, 2.0]), (950, []), (12, [0.5] * 16), (None, [0.5] * 16)]
    df = spark.createDataFrame([(i, v, 7) for i, v in vectors], "vec_id long, embedding array<double>, score int").repartition(4)
    usable = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for i in {i for i, _ in usable if i % 50 == 0}:
        for q in (v for j, v in usable if j == i):
            scored = sorted(((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q)))[:5]
            want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)}
    for block in (1 << 15, 3):
        got = topk.top_k(df, F.col("id") % 50 == 0, block_queries=block, leaf=8)
        assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(df.limit(0), F.col("id") % 50 == 0).count() == 0


def brute_top(ids, v, k=5):
    out = set()
    for i in np.flatnonzero(ids % 50 == 0):
        scored = sorted((-int(np.dot(v[i].astype(object), x)), int(j)) for j, x in zip(ids, v, strict=True) if j != ids[i])
        out |= {(int(ids[i]), j, -s) for s, j in scored[:k]}
    return out


@pytest.mark.parametrize("kind, most", [("unclustered", 1.0), ("clustered", 0.4), ("equal", 0.4), ("large", 1.0)])
def test_cover_tree(kind, most):
    """Nodes split at any dimension, keep a cover tree's invariants, and prune where the data allow it."""
    rng = np.random.default_rng(2)
    base = rng.normal(0, 50, (20, 48))
    v = {"unclustered": rng.normal(0, 50, (900, 48)), "clustered": base[rng.integers(0, 20, 900)] + rng.normal(0, 4, (900, 48)), "equal": base[np.arange(900) % 20], "large": rng.normal(0, 2.0**26, (900, 48))}[kind]
    ids, v = np.arange(900), np.floor(v).astype(np.int64)
    queries, rows, counts = topk.Side(ids[::50], v[::50], 4), topk.Side(ids, v, 16), []
    got = {(int(a), int(b), int(s)) for part in topk.dual_search(queries, rows, 5, counts) for a, b, s in zip(*part, strict=True)}
    assert got == brute_top(ids, v) and sum(counts) <= most * 18 * 900
    tree = rows.tree
    assert len(tree.center) > 20 and sorted(tree.order) == list(range(900))
    for i, below in enumerate(tree.children):
        lo, hi = tree.range[i]
        away = np.linalg.norm((v[tree.order[lo:hi]] - v[tree.center[i]]).astype(float), axis=1)
        assert away.max() <= tree.radius[i] * (1 + 1e-6) + 1e-3
        assert not below or [tree.range[c] for c in below] == sorted(tree.range[c] for c in below) and sum(b - a for a, b in map(tree.range.__getitem__, below)) == hi - lo
        if below:
            centers = v[[tree.center[c] for c in below]].astype(float)
            apart = np.linalg.norm(centers[:, None] - centers, axis=2)[np.triu_indices(len(below), 1)]
            assert apart.min(initial=np.inf) * (1 + 1e-6) + 1e-3 >= max(tree.radius[c] for c in below[1:]) if len(below) > 1 else True


def test_scores_beyond_a_long_are_refused():
    v = np.full((3, 4), 1 << 40)
    with pytest.raises(OverflowError):
        list(topk.dual_search(topk.Side(np.arange(3), v, 4), topk.Side(np.arange(3), v, 4), 2))
