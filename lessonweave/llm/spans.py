"""Places of a pattern's matches in long texts, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums are folded over so many items at a time, as appending to an array copies it.
_FOLD = 256


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _fold(x: Column, start: Column, combine) -> Column:
    zero = F.struct(start.cast("long").alias("t"), F.array().cast("array<bigint>").alias("a"))

    def step(acc: Column, v: Column) -> Column:
        t = combine(acc["t"], v)
        return F.struct(t.alias("t"), F.array_append(acc["a"], t).alias("a"))

    return F.aggregate(x, zero, step, lambda acc: acc["a"])


def running(x: Column, combine=lambda a, b: a + b, levels: int = 2) -> Column:
    """``combine`` of 0 and all items up to and with each, of an array of integers, in time n * 256 up to some millions of items."""
    x = x.cast("array<bigint>")
    if levels == 1:
        return _fold(x, F.lit(0), combine)

    def long(v: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _FOLD).cast("int")), lambda i: F.slice(v, i * _FOLD + 1, F.lit(_FOLD)))

        def with_parts(p: Column) -> Column:
            ends = running(F.transform(p, lambda q: F.aggregate(q, F.lit(0).cast("long"), combine)), combine, levels - 1)
            starts = F.concat(F.array(F.lit(0).cast("long")), ends)
            return F.flatten(F.zip_with(p, F.slice(starts, F.lit(1), F.size(p)), lambda q, start: _fold(q, start, combine)))

        return bound(parts, with_parts)

    return bound(x, lambda v: F.when(F.size(v) <= _FOLD, _fold(v, F.lit(0), combine)).otherwise(long(v)))


def matches(text: Column, pattern: str, quick: Column, group: int | None = None, before: int = 0) -> Column:
    """(s, e, v, g, b) of each leftmost non-overlapping match, in order: code points, end exclusive; the match, a group of it,
    and up to so many characters before it. Texts for which ``quick`` doesn't hold have none."""
    empty = F.array().cast("array<struct<s:int,e:int,v:string,g:string,b:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.transform(found, lambda v: F.lit(None).cast("string"))
    parts = F.struct(found.alias("v"), inner.alias("g"), F.split(text, pattern, -1).alias("gaps"))

    def placed(p: Column) -> Column:
        rows = F.arrays_zip(p["v"].alias("v"), p["g"].alias("g"), F.slice(p["gaps"], F.lit(1), F.size(p["v"])).alias("gap"))
        ends = running(F.transform(rows, lambda r: F.length(r["gap"]) + F.length(r["v"])))

        def row(r: Column, e: Column) -> Column:
            b = F.right(r["gap"], F.lit(before)) if before else F.lit("")
            return F.struct((e - F.length(r["v"])).cast("int").alias("s"), e.cast("int").alias("e"), r["v"].alias("v"), r["g"].alias("g"), b.alias("b"))

        return F.when(F.size(p["v"]) > 0, F.zip_with(rows, ends, row)).otherwise(empty)

    return F.when(quick, bound(parts, placed)).otherwise(empty)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
