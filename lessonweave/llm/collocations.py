"""Phrases that stand together more often than their parts: an FM-index per shard, sums across shards.

A shard is a bounded block of one language's words, as ids with a 0 after each piece of text. Its index has the
suffix orders of the words and of the words backwards (as deep as phrases go), and the Burrows-Wheeler transform of each. A phrase is a
pair of intervals, one in either order; extending it by a word on the left narrows the first and moves the second along, on
the right the other way round. All phrases of one length are extended at once: rows sorted by the transform's word
are the places that each extension leads to, so the runs of equal words and intervals in them are the new intervals, and
their lengths the counts. Counts of all shards are added up by Spark; where a long piece is cut between shards, they
overlap by a phrase less a word, and what lies in the overlap is counted off again.

Everything after the sums rests on phrases with at least the least count, as no candidate has a rarer part. So longer
phrases are looked for in passes: words and pairs first, then each length with only those phrases extended whose parts, one word
shorter, have the count. Shards know these by a bit table of hashes, whose size is a parameter: what it lets through beyond
them is counted and dropped later, so that a full table costs time and never a phrase.

Defined cases: a null text is empty; a null language is ``und``; texts without words add nothing; repeated rows count as
often as they occur; ties of the score are settled by count, then by the phrase's bytes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lessonweave.llm.bytewords import mix
from lessonweave.llm.common import durable, flat_text, in_arrow, spans_of_rows

LONGEST, LEAST, COVERED, TOP = 3, 10, 50, 2000
#: Words of a shard, and bytes of text that are cut into words at a time.
SHARD_WORDS, SHARD_BYTES = 1 << 20, 1 << 23
#: Tasks that find the best of a language before one does.
PARTS_OF_TOP = 16
#: 64-bit slots of the table of frequent phrases: 8 MB.
SLOTS = 1 << 20
#: A side is broadcast up to so many rows.
SMALL = 200_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_KIND = bytes(2 if c in b".,;:!?\n\x0b\x0c\r" else 1 if c in b" \t" else 0 for c in range(256))


def _sorted_places(key: np.ndarray) -> np.ndarray:
    """A stable order of small numbers: their places are sorted along with them."""
    bits = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    return np.sort((key.astype(np.int64) << bits) | np.arange(len(key))) & ((1 << bits) - 1)


@dataclass
class Phrases:
    """Phrases of one length: places and lengths of their intervals in both orders; their first and last words; and the phrases
    that are left without either, as places in the list before (``rest`` lacks the first word, ``front`` the last)."""

    left: np.ndarray
    right: np.ndarray
    count: np.ndarray
    word: np.ndarray
    parent: np.ndarray


class WordIndex:
    """Both directions of an FM-index over word ids from 1; 0 parts pieces and belongs to no phrase."""

    def __init__(self, ids: np.ndarray, depth: int):
        """``depth``: the words of the longest phrases, which are found by extending those with one word less."""
        self.n_ids = int(ids.max(initial=0)) + 1
        self.ids, self.depth = ids, max(1, depth - 1)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=self.n_ids))))

    @cached_property
    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        return self._order(self.ids)

    @cached_property
    def backward(self) -> tuple[np.ndarray, np.ndarray]:
        return self._order(self.ids[::-1])

    def _order(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word before each suffix, in the suffixes' order; these rows sorted by that word)."""
        key = ids.astype(np.int64)
        for j in range(1, self.depth):
            if int(key.max(initial=0) + 1).bit_length() + (self.n_ids * len(ids)).bit_length() > 62:
                key = np.unique(key, return_inverse=True)[1]
            key = key * self.n_ids + np.roll(ids, -j)
        before = np.roll(ids, 1)[_sorted_places(key)]
        return before, _sorted_places(before)

    def words(self) -> Phrases:
        at, count = self.first[1:-1], np.diff(self.first[1:])
        return Phrases(at, at.copy(), count, np.arange(1, self.n_ids), np.zeros(len(at), np.int64))

    def _extend(self, side: tuple[np.ndarray, np.ndarray], start: np.ndarray, other: np.ndarray, count: np.ndarray, last: bool) -> tuple[np.ndarray, ...]:
        """(start, start in the other order, count, word, parent) of all phrases longer by one word; the ``last`` are not extended and need no other start."""
        before, rows = side
        owner = np.full(len(before), -1, np.int64)
        held = np.concatenate(([0], np.cumsum(count)))
        owner[np.repeat(start - held[:-1], count) + np.arange(held[-1])] = np.repeat(np.arange(len(start)), count)
        word, own = before[rows], owner[rows]
        edge = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(own, prepend=-2) != 0))
        size = np.diff(np.append(edge, len(rows)))
        word, own = word[edge], own[edge]
        kept = (own >= 0) & (word > 0)
        if last:
            return edge[kept], edge[kept], size[kept], word[kept], own[kept]
        # In the other order, a phrase's longer ones follow each other by the word that was added.
        held_by = np.flatnonzero(own >= 0)
        by_owner = held_by[_sorted_places(own[held_by])]
        sizes = size[by_owner]
        passed = np.cumsum(sizes) - sizes
        first = np.flatnonzero(np.diff(own[by_owner], prepend=-1) != 0)
        passed -= np.repeat(passed[first], np.diff(np.append(first, len(by_owner))))
        moved = np.zeros(len(edge), np.int64)
        moved[by_owner] = other[own[by_owner]] + passed
        return edge[kept], moved[kept], size[kept], word[kept], own[kept]

    def extend_left(self, p: Phrases, last: bool = False) -> Phrases:
        left, right, count, word, parent = self._extend(self.forward, p.left, p.right, p.count, last)
        return Phrases(left, right, count, word, parent)

    def extend_right(self, p: Phrases, last: bool = False) -> Phrases:
        right, left, count, word, parent = self._extend(self.backward, p.right, p.left, p.count, last)
        return Phrases(left, right, count, word, parent)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(different words, the id of each word from 1, its row, whether a piece begins with it) of texts as UTF-8 bytes."""
    # A line feed after each text parts it from the next.
    low = np.insert(data, offsets[1:], 10).tobytes().translate(_LOWER)
    ends_of_rows = offsets[1:] + np.arange(1, len(offsets))
    kind = np.frombuffer(low.translate(_KIND), np.uint8)
    inside = kind == 0
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        turns = np.concatenate(([0], turns))
    start, end = turns[0::2], turns[1::2]
    row = np.searchsorted(ends_of_rows, start, side="right")
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    begins = np.ones(len(start), bool)
    begins[1:] = piece[1:] != piece[:-1]
    # Words and what stands between them, in turn, are values over one buffer.
    ends = np.empty(2 * len(start), np.int64)
    ends[0::2], ends[1::2] = start, end
    if len(start) == 0:
        return pa.array([], pa.large_string()), start, row, begins
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(low)])
    coded = values.take(pa.array(np.arange(0, len(ends) - 1, 2))).dictionary_encode()
    return coded.dictionary.cast(pa.large_string()), np.asarray(coded.indices).astype(np.int64) + 1, row, begins


def shards(ids: np.ndarray, begins: np.ndarray, size: int, longest: int):
    """(ids with a 0 after each piece, ids to be counted off) of runs of at most ``size`` words, cut between
    pieces where one ends in the run's second half."""
    lo, n = 0, len(ids)
    ends = np.flatnonzero(begins)
    while lo < n:
        hi, overlap = min(n, lo + size), 0
        if hi < n:
            at = int(ends[np.searchsorted(ends, hi, side="right") - 1])
            if at > lo + size // 2:
                hi = at
            else:
                rest = int(ends[min(np.searchsorted(ends, hi, side="right"), len(ends) - 1)])
                overlap = min(longest - 1, (rest if rest > hi else n) - hi)
        own, new = ids[lo : hi + overlap], begins[lo : hi + overlap].copy()
        new[0] = False
        yield np.append(np.insert(own, np.flatnonzero(new), 0), 0), ids[hi : hi + overlap]
        lo = hi


def counted(ids: np.ndarray, longest: int, often=None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length, the ids (phrase, word) and the counts of all phrases of a shard. With ``often``, which tells the phrases whose
    count may suffice, only those of one word less than the longest are extended, and only phrases of which both ends are such."""
    index = WordIndex(ids, longest)
    p = index.words()
    spelled = p.word[:, None]
    found = [(spelled, p.count)]
    for k in range(1, longest):
        if often and k == longest - 1:
            kept = often(spelled)
            p, spelled = Phrases(*(x[kept] for x in (p.left, p.right, p.count, p.word, p.parent))), spelled[kept]
        # In turn, so that both directions are narrowed.
        left = k % 2 == 1
        p = (index.extend_left if left else index.extend_right)(p, last=k == longest - 1)
        before = spelled[p.parent]
        spelled = np.hstack((p.word[:, None], before) if left else (before, p.word[:, None]))
        found.append((spelled, p.count))
    found = [(s[c > 0], c[c > 0]) for s, c in found]
    if often:
        s, c = found[-1]
        kept = often(s[:, :-1]) & often(s[:, 1:])
        found[-1] = s[kept], c[kept]
    return found


class BitTable:
    """Which hashes were put in: two bits for each."""

    def __init__(self, masks: np.ndarray):
        self.masks = masks

    @staticmethod
    def places(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Both (slot, mask) of each hash; slots have 64 bits."""
        both = np.concatenate((h, mix(h ^ np.uint64(0x9E3779B97F4A7C15))))
        return (both >> np.uint64(6)).astype(np.int64) % size, np.uint64(1) << (both & np.uint64(63))

    def holds(self, h: np.ndarray) -> np.ndarray:
        slot, mask = self.places(h, len(self.masks))
        return ((self.masks[slot] & mask) != 0).reshape(2, -1).all(axis=0)


def _hashes(words: list[str], salt: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(salt)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _hash_of(words: np.ndarray) -> np.ndarray:
    """A hash of each row of words' hashes, in order."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(words), np.uint64)
        for column in words.T:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def bit_table(phrases: DataFrame, slots: int = SLOTS) -> BitTable:
    """The table of phrases (lang, phrase) of one length. Each task sets the bits of its own; they are joined by slot."""

    def run(batches):
        masks = np.zeros(slots, np.uint64)
        for batch in batches:
            for lang in set(batch.column(0).to_pylist()):
                own = [p.split(" ") for x, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if x == lang]
                flat = _hashes([w for p in own for w in p], lang)
                slot, mask = BitTable.places(_hash_of(flat.reshape(len(own), -1)), slots)
                np.bitwise_or.at(masks, slot, mask)
        used = np.flatnonzero(masks)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(masks[used].view(np.int64))], names=["slot", "mask"])

    masks = np.zeros(slots, np.int64)
    found = in_arrow(phrases.select("lang", "phrase"), run, "slot int, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks[found.column("slot").to_numpy()] = found.column("mask").to_numpy()
    return BitTable(masks.view(np.uint64))


def _written(words: pa.Array, spelled: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(*[words.take(pa.array(c - 1)) for c in spelled.T], pa.scalar(" ", pa.large_string()))


def phrase_counts(documents: DataFrame, sizes: list[int], table: BitTable | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, f) of all phrases with so many words; with a null phrase, the count of all words, if one-word phrases are wanted.
    With ``table``, only phrases of which it may hold both ends."""
    rows = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    longest = max(sizes)
    known = rows.sparkSession.sparkContext.broadcast(table.masks) if table else None  # of a fixed size

    def rows_of(lang, words: pa.Array, spelled: np.ndarray, count: np.ndarray):
        for lo in range(0, len(count), 100_000):
            at = slice(lo, lo + 100_000)
            phrase = _written(words, spelled[at]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(phrase)), phrase, pa.array(count[at], pa.int64())], names=["lang", "phrase", "f"])

    def shard_rows(name, words: pa.Array, own: np.ndarray, begins: np.ndarray):
        if 1 in sizes:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([None], pa.string()), pa.array([len(own)], pa.int64())], names=["lang", "phrase", "f"])
        for shard, again in shards(own, begins, SHARD_WORDS, longest):
            used = np.flatnonzero(np.bincount(shard))
            local = np.zeros(used[-1] + 1, np.int64)
            local[used] = np.arange(len(used))
            local = local[shard]
            often = None
            if known:
                hashed = np.zeros(len(used), np.uint64)
                hashed[1:] = _hashes(words.take(pa.array(used[1:] - 1)).to_pylist(), name)
                bits = BitTable(known.value)
                often = lambda spelled, hashed=hashed, bits=bits: bits.holds(_hash_of(hashed[spelled]))
            for spelled, count in counted(local, longest, often):
                if spelled.shape[1] in sizes:
                    yield from rows_of(name, words, used[spelled], count)
            for size in (k for k in sizes if k <= len(again)):
                twice = np.lib.stride_tricks.sliding_window_view(again, size)
                yield from rows_of(name, words, twice, np.full(len(twice), -1))

    def run(batches):
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            langs = batch.column(0).dictionary_encode()
            for lo, hi in spans_of_rows(offsets, SHARD_BYTES):
                words, ids, row, begins = words_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                of = np.asarray(langs.indices)[lo:hi][row]
                for k in np.unique(of):
                    yield from shard_rows(langs.dictionary[int(k)].as_py(), words, ids[of == k], begins[of == k])

    # A shard has added up its own, so that adding up again before the shuffle would only fill memory.
    return in_arrow(rows, run, "lang string, phrase string, f long").repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(documents: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f) of phrases with at least the least count; with a null phrase, the count of all words."""
    size = F.size(F.split("phrase", " "))
    found = durable(phrase_counts(documents, [1, 2] if longest > 1 else [1], None, text, lang).where((F.col("f") >= least) | F.col("phrase").isNull()))
    level = found
    for k in range(3, longest + 1):
        table = bit_table(level.where(F.col("phrase").isNotNull() & (size == k - 1)))
        level = durable(phrase_counts(documents, [k], table, text, lang).where(F.col("f") >= least))
        found = found.unionByName(level)
    return found


def _parts(words: Column, k: Column) -> tuple[Column, Column]:
    return F.array_join(F.slice(words, F.lit(1), k), " "), F.array_join(F.slice(words, k + 1, F.size(words)), " ")


def _joined(large: DataFrame, small: DataFrame, few: bool, on: list[str], how: str = "inner") -> DataFrame:
    return large.join(F.broadcast(small) if few else small, on, how)


def collocations(documents: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that no longer one covers: phrases of 2 to ``longest`` words with a
    count of ``least`` or more; of the ways to cut one in two, the lowest-scoring counts."""
    counts = frequent_phrases(documents, text, lang, longest, least)
    total = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))  # a row for each language
    some = counts.where("phrase IS NOT NULL")
    few = some.count() <= SMALL
    words = F.split("phrase", " ")
    long = some.where(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("f").alias("a"), words.alias("words"))
    cuts = long.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    first, rest = _parts(F.col("words"), F.col("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    cuts = _joined(cuts, some.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), few, ["lang", "first"])
    cuts = _joined(cuts, some.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), few, ["lang", "rest"])
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", whole("a") * whole("a") * F.lit(1_000_000).cast("decimal(7,0)"), whole("l") * whole("r"))
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    within = long.select("lang", "a", F.explode(_shorter(F.col("words"))).alias("phrase"))
    longer = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    return left.join(total, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _shorter(words: Column) -> Column:
    """All phrases of two words or more within a longer one."""
    sizes = F.sequence(F.lit(2), F.greatest(F.size(words) - 1, F.lit(2)))
    of = lambda size: F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1))), lambda at: F.array_join(F.slice(words, at, size), " "))
    return F.when(F.size(words) > 2, F.array_distinct(F.flatten(F.transform(sizes, of)))).otherwise(F.array().cast("array<string>"))


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` by score, count and phrase: first those of parts of a language, then those of all of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS_OF_TOP))
    some = found.withColumn("__p", part).withColumn("__k", F.row_number().over(Window.partitionBy("lang", "__p").orderBy(*order))).where(F.col("__k") <= top)
    return some.drop("__p", "__k").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    found = best(collocations(table(spark, sf_dir, "documents").select("lang", "text")))
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
q AS (SELECT lang, d, unnest(ps) AS piece, generate_subscripts(ps, 1) AS p FROM p),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM q),
g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (SELECT lang, m, list_aggregate(ws[i : i + m - 1], 'string_agg', ' ') AS phrase, count(*) AS f FROM g, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(ws) GROUP BY 1, 2, 3),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT lang, m, phrase, a, unnest(range(1, m)) AS k, ws FROM c),
s AS (SELECT k.lang, k.m, k.phrase, k.a, k.k, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * k.a * k.a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.m = k.k AND x.phrase = list_aggregate(k.ws[1 : k.k], 'string_agg', ' ') JOIN f y ON y.lang = k.lang AND y.m = k.m - k.k AND y.phrase = list_aggregate(k.ws[k.k + 1 :], 'string_agg', ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, part, max(a) AS longer FROM (SELECT lang, a, ws[1] || ' ' || ws[2] AS part FROM c WHERE m = 3 UNION ALL SELECT lang, a, ws[2] || ' ' || ws[3] FROM c WHERE m = 3) GROUP BY 1, 2),
z AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, n.n, b.score FROM b JOIN n USING (lang) LEFT JOIN o ON o.lang = b.lang AND o.part = b.phrase AND b.m = 2 WHERE o.longer IS NULL OR 100 * o.longer < 50 * b.a)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score FROM z WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000
"""
