"""Ordered sequences and page geometry: islands, forward fill, look-ahead, repair of numbers, rectangles."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.operators.scans import RANGE, following, in_ranges, prefix_scan


def islands(rows: DataFrame, part: list[str], order: list[str], breaks: Column, name: str = "island") -> DataFrame:
    """Number the runs of rows: a new one begins where ``breaks`` holds; the first has number 0."""
    return prefix_scan(rows, part, order, sums={name: F.when(breaks, 1).otherwise(0)})


def paragraphs(lines: DataFrame, part: list[str], order: list[str], factor: float = 1.35) -> DataFrame:
    """Lines with y0, y1 and size to paragraphs: a gap of more than ``factor`` sizes begins a new one. A
    space joins two lines only between ASCII letters or digits."""
    ranged, split = in_ranges(lines, part, order)
    before = prefix_scan(ranged, part, order, lags={"__before": F.struct("y1", "size", "text")}, cut=split)
    gap = F.coalesce(F.col("y0") - F.col("__before.y1") > F.col("__before.size") * factor, F.lit(False))
    cut = prefix_scan(before.withColumn("__gap", gap), part, order, sums={"para": F.col("__gap").cast("int")}, cut=split)
    glue = F.when(~F.col("__gap") & F.col("__before.text").rlike("[0-9A-Za-z]$") & F.col("text").rlike("^[0-9A-Za-z]"), F.lit(" ")).otherwise(F.lit(""))
    parts = cut.withColumn("__t", F.concat(glue, "text"))
    return parts.groupBy(*part, "para").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "__t"))), lambda x: x["__t"]), "").alias("text"), F.count(F.lit(1)).alias("n_lines"))


def repair_numbers(rows: DataFrame, part: list[str], order: list[str], number: str) -> DataFrame:
    """Rows without a number get the number before plus one, from 1 where nothing stands before."""
    ranged, split = in_ranges(rows, part, order)
    placed = prefix_scan(ranged, part, order, sums={"__at": F.lit(1)}, cut=split)
    told = F.when(F.col(number).isNotNull(), F.struct(F.col(number).alias("n"), F.col("__at").alias("at")))
    found = prefix_scan(placed, part, order, lasts={"__told": told}, cut=split)
    fixed = F.coalesce(F.col("__told.n") + F.col("__at") - F.col("__told.at"), "__at")
    return found.withColumn("no", fixed).drop("__at", "__told", RANGE)


def followed_by(rows: DataFrame, part: list[str], order: list[str], within: dict[str, tuple[Column, int]]) -> DataFrame:
    """Columns that tell whether one of the next rows, so many as given, is of the kind."""
    most = max(n for _, n in within.values())
    kinds = F.struct(*[F.coalesce(what, F.lit(False)).alias(name) for name, (what, _) in within.items()])
    seen = following(rows, part, order, kinds, most, "__next")
    any_of = lambda name, n: F.exists(F.slice("__next", 1, n), lambda x: x[name]).alias(name)
    return seen.select(*rows.columns, *[any_of(name, n) for name, (_, n) in within.items()])


def mode_size(spans: DataFrame, part: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each part, the one seen first among equals."""
    counted = spans.groupBy(*part, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("seen"))
    return counted.groupBy(*part).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("seen"))).alias("m")).select(*part, f"m.{value}", "m.n")


def outside_bands(fragments: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """Fragments whose height's point at three fifths lies in no band of the same keys.

    A point is in a band if, of the bands that begin at it or before, one reaches it: so the running maximum of their ends
    tells, in one scan of points and bands by height. A fragment without a height is in none.
    """
    given = fragments.columns
    points = fragments.withColumns({"__y": F.col("y0") + 0.6 * (F.col("y1") - F.col("y0")), "__point": F.lit(1), "__hi": F.lit(None).cast("double")})
    begins = bands.where("lo IS NOT NULL AND hi IS NOT NULL").select(*keys, F.col("lo").cast("double").alias("__y"), F.lit(0).alias("__point"), F.col("hi").cast("double").alias("__hi"))
    both = points.where("__y IS NOT NULL").unionByName(begins, allowMissingColumns=True)
    scanned = prefix_scan(both, keys, ["__y", "__point"], highs={"__reached": F.col("__hi")})
    out = scanned.where("__point = 1 AND (__reached IS NULL OR __reached < __y)").select(*given)
    return out.unionByName(points.where("__y IS NULL").select(*given))


def uncovered(rects: DataFrame, images: DataFrame, key: str, share: float = 0.6, least: Column | None = None) -> DataFrame:
    """Rectangles that no image of the same page covers by more than ``share`` of their area, which is a half at least. ``least`` is that share of the area
    where the caller multiplies in another order, as products of doubles are rounded one by one.

    Such an image contains the rectangle's centre. Images are dealt to the cells of a grid that they touch, at a level where
    a cell is as large as they are, so at most four; a centre lies in one cell of each level. Of the images in a cell, those that lie within another
    are left out, edge by edge, so that a crowded cell has few.
    """
    if share < 0.5:
        raise ValueError("an image that covers less than a half needn't contain the centre")
    box = ["x0", "y0", "x1", "y1"]
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1e-6))
    sized = images.select(F.col(key).alias("__k"), *[F.col(c).cast("double").alias(c) for c in box]).withColumn("__level", F.ceil(F.log2(size)).cast("int"))
    levels = sorted(r[0] for r in sized.where("__level IS NOT NULL").select("__level").distinct().collect())  # sizes differ by 2**levels
    left = rects.withColumns({"__x": (F.col("x0") + F.col("x1")) / 2, "__y": (F.col("y0") + F.col("y1")) / 2})
    for level in levels:
        cell = lambda c, level=level: F.floor(c / 2.0**level)
        dealt = sized.where(F.col("__level") == level)
        for low, high, name in (("x0", "x1", "__cx"), ("y0", "y1", "__cy")):
            dealt = dealt.withColumn(name, F.explode(F.sequence(cell(F.col(low)), cell(F.col(high)))))
        for edge in box:
            furthest = F.min(edge) if edge in ("x0", "y0") else F.max(edge)
            dealt = dealt.groupBy("__k", "__cx", "__cy", *[c for c in box if c != edge]).agg(furthest.alias(edge))
        i = dealt.select("__k", "__cx", "__cy", *[F.col(c).alias(f"__i{c}") for c in box])
        wide = F.greatest(F.lit(0.0), F.least("x1", "__ix1") - F.greatest("x0", "__ix0"))
        high = F.greatest(F.lit(0.0), F.least("y1", "__iy1") - F.greatest("y0", "__iy0"))
        bound = share * ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))) if least is None else least
        here = (F.col(key) == F.col("__k")) & (cell(F.col("__x")) == F.col("__cx")) & (cell(F.col("__y")) == F.col("__cy"))
        left = left.join(i, here & (wide * high > bound), "left_anti")
    return left.drop("__x", "__y")


def merge_rects(rects: DataFrame, key: str, gap_y: float = 6.0, gap_x: float = 40.0) -> DataFrame:
    """(key, n, y0, x0, y1, x1): rectangles in (y0, x0) order, each united with the last cluster unless it lies further than the
    gaps from the cluster's box, which grows. As the box is what decides, this is a fold: rows reach a task sorted by page and
    stream through it, with one box for a state."""
    box = ["y0", "x0", "y1", "x1"]
    rows = rects.select(key, *[F.col(c).cast("double").alias(c) for c in box]).dropna(subset=box)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, n, now, seen = None, 0, None, False
        for batch in batches:
            out: list[tuple] = []
            for p, *r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not seen or p != page:
                    if seen:
                        out.append((page, n, *now))
                    page, n, now, seen = p, 0, r, True
                elif r[0] - now[2] <= gap_y and r[1] - now[3] <= gap_x and now[1] - r[3] <= gap_x:
                    now = [min(now[0], r[0]), min(now[1], r[1]), max(now[2], r[2]), max(now[3], r[3])]
                else:
                    out.append((page, n, *now))
                    n, now = n + 1, r
            if out:
                yield pack(out)
        if seen:
            yield pack([(page, n, *now)])

    def pack(out: list[tuple]) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), *[pa.float64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[key, "n", *box])

    kind = rows.select(key).limit(0).toArrow().schema.field(0).type
    ordered = rows.repartition(key).sortWithinPartitions(key, *box)
    return ordered.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, n long, y0 double, x0 double, y1 double, x1 double")


def option_layout(lengths: Column) -> Column:
    """How a question's options are set: in one line, in two, or one to a line."""
    longest, total = F.array_max(lengths), F.aggregate(lengths, F.lit(0), lambda a, x: a + x)
    return F.when((longest <= 10) & (total <= 36), "l1").when(total <= 76, "l2").otherwise("l4")


def marker_slices(text: Column, marker: str) -> Column:
    """(no, body) of each marker up to the next one. ``marker`` has the number as its only group."""
    numbers, bodies = F.regexp_extract_all(text, F.lit(marker), F.lit(1)), F.split(text, marker)
    return F.transform(numbers, lambda n, i: F.struct(n.cast("int").alias("no"), F.trim(F.get(bodies, i + 1)).alias("body")))
