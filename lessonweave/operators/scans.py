"""Ordered scans over parts of any size: running sums and maxima, forward fills, places and look-ahead.

A window over a part puts all its rows in one task. Here a part that has more rows than two tasks' share of all is cut into
ranges of its order, which go to different tasks; each range is scanned on its own, leaves a row of sums and last values, and
gets what the ranges before it left. Parts are few that are so large, since their shares add up to one.

``order`` is one column or several, of which the first is a number: ranges are cut by its values, so that rows that share
one stay together and the other columns settle their order. Null parts are parts; the first column of the order isn't null.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A part of fewer rows is never cut.
LEAST_ROWS = 10_000
RANGE = "__range"
Order = str | list[str]


def _listed(order: Order) -> list[str]:
    return [order] if isinstance(order, str) else order


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__k_{k}"]) for k in keys])


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in df.columns if c not in keys])


def in_ranges(rows: DataFrame, part: list[str], order: Order, least: int = LEAST_ROWS) -> tuple[DataFrame, bool]:
    """``rows`` with ``__range``, which is 0 but in large parts, and whether there are any of these."""
    first = _listed(order)[0]
    tasks = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    told = counts.agg(F.sum("__n").alias("rows"), F.max("__n").alias("most")).first()
    share = max(least, 2 * (told["rows"] or 0) // tasks)
    if (told["most"] or 0) <= share:
        return rows.withColumn(RANGE, F.lit(0)), False
    pieces = max(2, -(-2 * told["most"] // share))
    cuts = F.percentile_approx(first, F.array(*[F.lit(k / pieces) for k in range(1, pieces)]), F.lit(100 * pieces))
    # At most half as many parts as there are tasks.
    found = _keyed(counts.where(F.col("__n") > share).select(*part), part)
    some = rows.join(F.broadcast(found), _same(rows, found, part), "left_semi")
    bounds = _keyed(some.groupBy(*part).agg(F.array_distinct(cuts).alias("__cuts")), part)
    dealt = rows.join(F.broadcast(bounds), _same(rows, bounds, part), "left")
    at = F.coalesce(F.size(F.filter("__cuts", lambda c: c < F.col(first))), F.lit(0))
    return dealt.withColumn(RANGE, F.when(F.col("__cuts").isNull(), 0).otherwise(at)).drop("__cuts", *[f"__k_{k}" for k in part]), True


def _carried(scanned: DataFrame, left: DataFrame, part: list[str]) -> DataFrame:
    """``scanned`` with what is carried into each range; ``left`` has a row for each range of the large parts and no other."""
    keys = [*part, RANGE]
    own = _keyed(left, keys)
    return scanned.join(F.broadcast(own), _same(scanned, own, keys), "left").drop(*[f"__k_{k}" for k in keys])


#: How each kind of scan adds up over the rows of a range, and how it takes in what came before.
_KINDS = {
    "sums": (F.sum, lambda now, before: now + F.coalesce(before, F.lit(0))),
    "highs": (F.max, lambda now, before: F.greatest(now, before)),
    "lasts": (None, lambda now, before: F.coalesce(now, before)),
    "firsts": (None, lambda now, before: F.coalesce(before, now)),
    "lags": (None, lambda now, before: F.coalesce(now, before)),
}


def prefix_scan(
    rows: DataFrame, part: list[str], order: Order, sums: Mapping[str, Column] | None = None, lasts: Mapping[str, Column] | None = None, highs: Mapping[str, Column] | None = None,
    firsts: Mapping[str, Column] | None = None, lags: Mapping[str, Column] | None = None, least: int = LEAST_ROWS, cut: bool | None = None,
) -> DataFrame:
    """``rows`` with running sums (long), maxima and last values that aren't null, each up to and with the row itself, with
    ``firsts``, the whole part's first value that isn't null, and with ``lags``, the value of the row before. With ``cut``, they have ``__range`` already, and keep it."""
    wanted = {k: (kind, F.coalesce(v.cast("long"), F.lit(0)) if kind == "sums" else F.struct(v.alias("v")) if kind == "lags" else v) for kind, given in (("sums", sums), ("highs", highs), ("lasts", lasts), ("firsts", firsts), ("lags", lags)) for k, v in (given or {}).items()}
    kept, order = rows.columns, _listed(order)
    marked = rows.withColumns({f"__v_{k}": v for k, (_, v) in wanted.items()})
    ranged, cut = in_ranges(marked, part, order, least) if cut is None else (marked, cut)
    by = Window.partitionBy(*part, RANGE).orderBy(*order)
    upto, every = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def local(k: str, kind: str) -> Column:
        v = f"__v_{k}"
        if kind == "lasts":
            return F.last(v, ignorenulls=True).over(upto)
        if kind == "lags":
            return F.lag(v).over(by)
        return F.first(v, ignorenulls=True).over(every) if kind == "firsts" else _KINDS[kind][0](v).over(upto)

    scanned = ranged.withColumns({k: local(k, kind) for k, (kind, _) in wanted.items()})
    if cut:
        place = F.struct(*order)

        def end(k: str, kind: str) -> Column:
            v = f"__v_{k}"
            if kind in ("lasts", "firsts", "lags"):
                return (F.min_by if kind == "firsts" else F.max_by)(v, F.when(F.col(v).isNotNull(), place)).alias(f"__c_{k}")
            return _KINDS[kind][0](v).alias(f"__c_{k}")

        ends = ranged.groupBy(*part, RANGE).agg(*[end(k, kind) for k, (kind, _) in wanted.items()])
        whole = Window.partitionBy(*part)
        ordered = whole.orderBy(RANGE)
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)

        def carry(k: str, kind: str) -> Column:
            c = f"__c_{k}"
            over = F.first(c, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) if kind == "firsts" else (F.last(c, ignorenulls=True) if kind in ("lasts", "lags") else _KINDS[kind][0](c)).over(before)
            return over.alias(f"__b_{k}")

        left = ends.withColumn("__top", F.max(RANGE).over(whole)).where("__top > 0").select(*part, RANGE, *[carry(k, kind) for k, (kind, _) in wanted.items()])
        scanned = _carried(scanned, left, part)
        scanned = scanned.withColumns({k: _KINDS[kind][1](F.col(k), F.col(f"__b_{k}")) for k, (kind, _) in wanted.items()})
    return scanned.select(*kept, *[F.col(f"{k}.v").alias(k) if kind == "lags" else k for k, (kind, _) in wanted.items()])


def following(rows: DataFrame, part: list[str], order: Order, value: Column, n: int, name: str, least: int = LEAST_ROWS, cut: bool | None = None) -> DataFrame:
    """``rows`` with an array of the ``value`` of up to ``n`` rows after each; ``cut`` as above."""
    given, order = rows.columns, _listed(order)
    marked = rows.withColumn("__v", value)
    ranged, cut = in_ranges(marked, part, order, least) if cut is None else (marked, cut)
    by = Window.partitionBy(*part, RANGE).orderBy(*order)
    found = ranged.withColumn(name, F.collect_list(F.struct(F.col("__v").alias("v"))).over(by.rowsBetween(1, n)))
    if cut:
        heads = ranged.withColumn("__at", F.row_number().over(by)).where(F.col("__at") <= n).groupBy(*part, RANGE).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__v"))), lambda x: F.struct(x["__v"].alias("v"))).alias("__head"))
        next_ones = Window.partitionBy(*part).orderBy(RANGE).rowsBetween(1, n)
        left = heads.withColumn("__top", F.max(RANGE).over(Window.partitionBy(*part))).where("__top > 0").select(*part, RANGE, F.flatten(F.collect_list("__head").over(next_ones)).alias("__more"))
        found = _carried(found, left, part)
        found = found.withColumn(name, F.slice(F.concat(name, F.coalesce("__more", F.array().cast(found.schema[name].dataType))), F.lit(1), F.lit(n)))
    return found.withColumn(name, F.transform(name, lambda x: x["v"])).select(*given, name)


def places(rows: DataFrame, part: list[str], order: Order, name: str, least: int = LEAST_ROWS) -> DataFrame:
    """``rows`` with their place from 1 in their part."""
    return prefix_scan(rows, part, order, sums={name: F.lit(1)}, least=least)
