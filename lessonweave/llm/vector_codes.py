"""Product codes for vectors by active-entry Lloyd rounds, exact in integers.

A vector's components become integers, and the vector is cut into equal parts; each part position has a codebook of
a few entries. A round assigns every part to its nearest entry and then moves each entry to the floored mean of its
parts. A part keeps its entry and the exact distance to it from round to round: where that entry didn't move, only
entries that did are compared with what is stored; other parts are compared with all entries. Ties go to the lower index.

The parts' state is a table that each round reads and writes anew in the checkpoint folder (the one before it is then deleted); what meets on the
driver are the sums of each entry, a few numbers per task and entry, added up by Spark before.

Defined cases: rows whose vector is null or holds null or non-finite components are left out. Codebooks start from the rows
with the smallest ids, ties by the vector's components, null ids last; fewer rows give fewer entries. Vectors are taken
to have the length that most have (ties: the longer one) among lengths that the number of parts divides; rows of other lengths stay, with a null code and
error. Repeated rows each get their row. Components whose squares pass 64 bits are reckoned in Python's integers; an
error beyond a long is null. Without rows, the result is empty.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.common import durable, forget, in_arrow, mapped

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Sums travel in pieces of so many bits, of which 2**23 may be added.
_PIECE, _PIECES = 40, 4
#: Up to so many labels, their sums are broadcast; of more, only those of labels that a thousandth of the rows has.
SMALL = 100_000


@dataclass(frozen=True)
class Shape:
    """Length of the vectors, parts, and the integers that hold components and distances without loss."""

    length: int
    parts: int
    component: str
    distance: str

    @property
    def width(self) -> int:
        return self.length // self.parts


def whole_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of finite components."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(v.isNotNull() & finite)


def shape_of(whole: DataFrame, vector: str, parts: int) -> Shape | None:
    """One aggregation over lengths; there are few different ones."""
    x = F.col(vector).cast("array<double>")
    sizes = whole.where(F.size(vector) % parts == 0).groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform(x, F.abs))).alias("most"))
    found = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if found is None:
        return None
    most = int(found["most"] or 0) * SCALE + SCALE
    furthest = (2 * most) ** 2 * max(1, found["size"])
    component = next((kind for kind in ("int16", "int32") if most < 1 << np.iinfo(kind).bits - 1), "int64" if furthest < 1 << 62 else "object")
    distance = "int32" if furthest < 1 << 31 else "int64" if furthest < 1 << 62 else "object"
    return Shape(found["size"], parts, component if distance != "object" else "object", distance)


def integers(values: np.ndarray, shape: Shape) -> np.ndarray:
    """Components of vectors as integers, by part: (row, part, position)."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if shape.component == "object":
        whole = np.empty(scaled.size, object)
        whole[:] = [int(v) for v in scaled.ravel()]
    else:
        whole = scaled.astype(np.int64)
    return whole.reshape(-1, shape.parts, shape.width)


def assign(x: np.ndarray, books: np.ndarray, moved: np.ndarray, code: np.ndarray | None, far: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(code, distance) of each part. ``books`` is (part, entry, position), ``moved`` (part, entry) tells which entries
    changed since ``code`` and ``far`` were found; without these, all are compared."""
    n, parts = x.shape[:2]
    kind = object if x.dtype == object else np.int64
    new_code, new_far = np.zeros((n, parts), np.int64), np.zeros((n, parts), kind)
    for p in range(parts):
        part = x[:, p]

        def nearest(rows: np.ndarray, entries: np.ndarray, part=part, book=books[p]) -> tuple[np.ndarray, np.ndarray]:
            away = part[rows][:, None, :] - book[entries][None, :, :]
            d = (away * away).sum(axis=2) if away.shape[2] else np.zeros(away.shape[:2], kind)
            at = d.argmin(axis=1)  # the first of equals
            return entries[at], d[np.arange(len(d)), at]

        every = np.arange(books.shape[1])
        if code is None:
            new_code[:, p], new_far[:, p] = nearest(np.arange(n), every)
            continue
        new_code[:, p], new_far[:, p] = code[:, p], far[:, p]
        active = np.flatnonzero(moved[p])
        left = moved[p][code[:, p]]
        again = np.flatnonzero(left)
        if len(again):
            new_code[again, p], new_far[again, p] = nearest(again, every)
        stayed = np.flatnonzero(~left)
        if len(active) and len(stayed):
            c, d = nearest(stayed, active)
            old_c, old_d = new_code[stayed, p], new_far[stayed, p]
            better = (d < old_d) | ((d == old_d) & (c < old_c))
            new_code[stayed, p], new_far[stayed, p] = np.where(better, c, old_c), np.where(better, d, old_d)
    return new_code, new_far


def _packed(values: np.ndarray, kind: str) -> list[bytes]:
    rows = values.reshape(len(values), -1)
    if kind == "object":
        return [",".join(map(str, r)).encode() for r in rows]
    return [r.tobytes() for r in np.ascontiguousarray(rows.astype(np.dtype(kind).newbyteorder("<")))]


def _unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    rows = column.to_pylist()
    if kind == "object":
        out = np.empty((len(rows), width), object)
        for i, r in enumerate(rows):
            out[i] = [int(v) for v in r.decode().split(",")] if width else []
        return out
    return np.frombuffer(b"".join(rows), np.dtype(kind).newbyteorder("<")).reshape(len(rows), width).astype(np.int64)


_STATE = ["__x", "__code", "__far", "__error"]
#: Rows that are compared with all entries at a time, for bounded memory.
_STEP = 2_000


def _round(rows: DataFrame, shape: Shape, books: np.ndarray, moved: np.ndarray, first: bool) -> DataFrame:
    """The parts' state after an assignment. At first, the vector is read from ``__v``, and becomes integers."""
    keep = [c for c in rows.columns if c not in ("__v", *_STATE)]
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
        if first:
            x = integers(np.asarray(own["__v"].flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, shape.length), shape)
        else:
            x = _unpacked(own["__x"], shape.component, shape.length).reshape(-1, shape.parts, shape.width)
            old = _unpacked(own["__code"], "uint8", shape.parts), _unpacked(own["__far"], shape.distance, shape.parts)
        code, far = np.empty(x.shape[:2], np.int64), np.empty(x.shape[:2], object if shape.distance == "object" else np.int64)
        for lo in range(0, len(x), _STEP):
            at = slice(lo, lo + _STEP)
            code[at], far[at] = assign(x[at], books, moved, *((None, None) if first else (o[at] for o in old)))
        state = [pa.array(s, pa.binary()) for s in (_packed(x, shape.component), _packed(code, "uint8"), _packed(far, shape.distance))]
        error = pa.array([e if e < 1 << 63 else None for e in (int(sum(f)) for f in far)] if far.dtype == object else far.sum(axis=1), pa.int64())
        return pa.RecordBatch.from_arrays([*(own[c] for c in keep), *state, error], names=[*keep, *_STATE])

    return mapped(rows, one, f"{schema + ', ' if schema else ''}__x binary, __code binary, __far binary, __error long")


def _sums(state: DataFrame, shape: Shape, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(count of parts, sum of them) of each entry, exact. Each task adds up its own rows first."""
    pieces = _PIECES if shape.component == "object" else 2
    names = [f"s{j}_{k}" for j in range(shape.width) for k in range(pieces)]

    def run(batches):
        n = np.zeros((shape.parts, entries), np.int64)
        total = np.zeros((shape.parts, entries, shape.width), object)
        for batch in batches:
            x = _unpacked(batch.column(0), shape.component, shape.length).reshape(-1, shape.parts, shape.width)
            code = _unpacked(batch.column(1), "uint8", shape.parts)
            for p in range(shape.parts):
                for e in np.unique(code[:, p]):
                    own = x[code[:, p] == e, p]
                    n[p, e] += len(own)
                    total[p, e] += own.sum(axis=0).astype(object)
        used = np.argwhere(n)
        if len(used):
            columns = [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array([n[p, e] for p, e in used], pa.int64())]
            for j in range(shape.width):
                for k in range(pieces):
                    value = [int(total[p, e, j]) >> (_PIECE * k) for p, e in used]
                    columns.append(pa.array([v if k == pieces - 1 else v & ((1 << _PIECE) - 1) for v in value], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["p", "e", "n", *names])

    partial = in_arrow(state.select("__x", "__code"), run, ", ".join(["p int", "e int", "n long", *(f"{c} long" for c in names)]))
    count, total = np.zeros((shape.parts, entries), np.int64), np.zeros((shape.parts, entries, shape.width), object)
    for r in partial.groupBy("p", "e").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).collect():  # parts times entries at most
        count[r["p"], r["e"]] = r["n"]
        total[r["p"], r["e"]] = [sum(r[f"s{j}_{k}"] << (_PIECE * k) for k in range(pieces)) for j in range(shape.width)]
    return count, total


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """All columns of ``vectors`` but the vector, ``__code`` (binary, a byte for each part) and ``__error`` (long, the sum of
    squared distances), and the codebooks as integers (part, entry, position)."""
    if not 0 < entries <= 256:
        raise ValueError("a code has a byte for each part: 1 to 256 entries")
    keep = [c for c in vectors.columns if c != vector]
    whole = whole_vectors(vectors, vector)
    shape = shape_of(whole, vector, parts)
    if shape is None:
        none = np.zeros((parts, 0, 0), np.int64)
        return whole.select(*keep, F.lit(None).cast("binary").alias("__code"), F.lit(None).cast("long").alias("__error")), none
    fits = F.size(vector) == shape.length
    own = whole.where(fits).select(*keep, F.col(vector).cast("array<double>").alias("__v"))
    firsts = [r["__v"] for r in own.select(key, "__v").orderBy(F.col(key).asc_nulls_last(), "__v").limit(entries).collect()]
    books = integers(np.array(firsts, np.float64).reshape(-1, shape.length), shape).transpose(1, 0, 2)
    entries = books.shape[1]
    state = durable(_round(own, shape, books, np.ones(books.shape[:2], bool), True))
    for _ in range(rounds):
        n, total = _sums(state, shape, entries)
        new = books.copy()
        for p, e in np.argwhere(n):
            new[p, e] = [int(t) // int(n[p, e]) for t in total[p, e]]
        moved, books = (new != books).any(axis=2), new
        if not moved.any():
            break  # all further rounds would change nothing
        before, state = state, durable(_round(state, shape, books, moved, False))
        forget(before)
    coded = state.select(*keep, "__code", "__error")
    rest = whole.where(~fits).select(*keep, F.lit(None).cast("binary").alias("__code"), F.lit(None).cast("long").alias("__error"))
    return coded.unionByName(rest), books


def total_by(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over equal ``group``, nulls together.

    Sums are added up in each task before they meet. Few groups are broadcast; of many, those that hold a thousandth of
    all rows or more (a thousand at most) are, and only rows of rare groups are shuffled.
    """
    sums = durable(rows.groupBy(F.col(group).alias("__g")).agg(F.sum(F.col(value).cast("decimal(38,0)")).try_cast("long").alias(name), F.count(F.lit(1)).alias("__n")))
    told = sums.agg(F.count(F.lit(1)).alias("groups"), F.sum("__n").alias("rows")).first()
    if told["groups"] <= SMALL:
        return rows.join(F.broadcast(sums), F.col(group).eqNullSafe(F.col("__g")), "left").drop("__g", "__n")
    often = (F.col("__n") > told["rows"] // 1000) | F.col("__g").isNull()
    some = F.broadcast(sums.where(often).withColumn("__often", F.lit(True)))
    placed = rows.join(some, F.col(group).eqNullSafe(F.col("__g")), "left").drop("__g", "__n")
    hot = placed.where("__often").drop("__often")
    rare = placed.where("__often IS NULL").drop("__often", name).join(sums.where(~often), F.col(group) == F.col("__g")).drop("__g", "__n")
    return hot.unionByName(rare)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    rows = total_by(coded, "label", "__error", "label_error")
    return rows.select("vec_id", F.lower(F.hex("__code")).alias("code"), F.col("__error").alias("error"), "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
