"""Packing of tokenised documents into sequences by best-fit decreasing.

Each task packs its own documents, in blocks bounded by rows and tokens, so nothing is shuffled and no
source or group of copies can load one task. In a block, overlong documents are cut into full windows; the
remainders go, longest first, into the open window with the least sufficient room, which a segment tree
indexed by remaining capacity finds. Windows that are not full at the end of a block stay open for the next
one of the same task.

Ids come from the vocabulary file of the ``tokenizers`` library. Where its ranks are given too, ordinary
texts are encoded with ``tiktoken``, whose ids are the same and which is several times faster; a text that
holds a special token's string goes through ``tokenizers``.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; a text of any
length is packed whole; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.common import in_arrow

WINDOW = 1024
END_ID = 0
#: A block closes at so many documents or ids.
BLOCK_DOCS, BLOCK_IDS = 8192, 4 << 20

def encoder(json_path: str, ranks_path: str | None, pattern: str | None):
    """A function from a text to its ids. It lives as long as the task that made it, as workers outlive tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    held: list = []

    def full(text: str) -> list[int]:
        if not held:  # takes much memory, and few texts need it where there are ranks
            from tokenizers import Tokenizer

            held.append(Tokenizer.from_file(json_path))
        return held[0].encode(text, add_special_tokens=False).ids

    if not ranks_path:
        return full
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(json_path, encoding="utf-8") as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: full(text) if any(s in text for s in special) else fast(text)


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree that tells which capacities are in use."""

    def __init__(self, window: int):
        self.window = window
        self.size = 1 << window.bit_length()
        self.used = bytearray(2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(self.size)]

    def _mark(self, room: int, on: int) -> None:
        i = room + self.size
        self.used[i] = on
        while i > 1:
            i >>= 1
            on = self.used[2 * i] | self.used[2 * i + 1]
            if self.used[i] == on:
                break
            self.used[i] = on

    def put(self, room: int, window: int) -> None:
        if room:
            if not self.at[room]:
                self._mark(room, 1)
            self.at[room].append(window)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least room of at least ``need``."""
        i = need + self.size
        if not self.used[i]:
            while i > 1 and not (i & 1 == 0 and self.used[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i + (not self.used[2 * i])
        room = i - self.size
        window = self.at[room].pop()
        if not self.at[room]:
            self._mark(room, 0)
        return room, window


def pack_lengths(lengths: list[int], window: int, first_window: int, still_open: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int, list[tuple[int, int]]]:
    """Place pieces of at most ``window`` ids. Gives each piece's (window, offset), the next free window
    number, and the windows that are not full as (room, window)."""
    tree = OpenWindows(window)
    for room, w in still_open:
        tree.put(room, w)
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[k]
        room, w = tree.tightest(n) or (window, first_window)
        if w == first_window and room == window:
            first_window += 1
        placed[k] = (w, window - room)
        tree.put(room - n, w)
    return placed, first_window, [(room, w) for room, ws in enumerate(tree.at) for w in ws]


def pack(documents: DataFrame, window: int = WINDOW, end_id: int = END_ID, json_path: str | None = None, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset and its ids as
    little-endian unsigned 32-bit numbers."""
    if json_path is None:
        import public_tokenizers

        json_path, ranks_path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path, pattern)
        base, next_window, still_open = TaskContext.get().partitionId() << 36, 0, []
        names, docs, parts, n_ids = None, [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal next_window, still_open
            owner, start, ids = [], [], []
            for d, own in enumerate(parts):
                for at in range(0, len(own), window):
                    owner.append(d)
                    start.append(at)
                    ids.append(own[at : at + window])
            placed, next_window, still_open = pack_lengths([len(x) for x in ids], window, next_window, still_open)
            total = [len(p) for p in parts]
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(docs).take(pa.array(owner, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([total[d] for d in owner], pa.int64()),
                    pa.array([base + w for w, _ in placed], pa.int64()),
                    pa.array([o for _, o in placed], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                ],
                names=names,
            )

        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        for batch in batches:
            lo = 0
            for r, text in enumerate(batch.column(1)):
                own = array("I", encode(text.as_py() or ""))
                own.append(end_id)
                parts.append(own)
                n_ids += len(own)
                if len(parts) >= BLOCK_DOCS or n_ids >= BLOCK_IDS:
                    docs.append(batch.column(0).slice(lo, r + 1 - lo))
                    yield block()
                    lo, docs, parts, n_ids = r + 1, [], [], 0
            if lo < batch.num_rows:
                docs.append(batch.column(0).slice(lo))
        if parts:
            yield block()

    assert np.dtype("u4").itemsize == array("I").itemsize
    return in_arrow(documents.select("doc_id", F.col("text").cast("string").alias("text")), run, schema)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    return with_digest(pack(table(spark, sf_dir, "documents")))


def with_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
