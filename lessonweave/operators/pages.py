"""What stands on a page: lines to paragraphs, pictures and drawings, in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.checkpoints import durable
from lessonweave.operators.blocks import merge_rects, outside_bands, paragraphs, uncovered
from lessonweave.operators.scans import places

#: Pictures from this width; drawings from this width and height; what is a rule or a shading before and after drawings are merged.
PICTURE, DRAWING, MERGED, WIDE, LOW, LOW_MERGED = 40, 12, (30, 20), 6, 45, 60


def is_prose(text: Column) -> Column:
    return text.rlike("[一-鿿]")


def is_fragment(text: Column) -> Column:
    """A few signs of a formula, or nothing but ASCII."""
    t = F.trim(text)
    return (t != "") & (t.rlike(r"^[\w=＋\-*/±×÷≤≥<>φθ.()]{1,6}$") | t.rlike(r"^[\x00-\x7f]+$"))


def without_fragments(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines (text, y0, y1, x0, x1) without formulas that float: fragments at the right of all prose of their block, and those at the
    height of none. Where a block has no prose, all its fragments float."""
    prose = is_prose(F.col("text"))
    right = lines.where(prose).groupBy(*keys).agg(F.max("x1").alias("__right"))
    loose = ~prose & is_fragment(F.col("text"))
    placed = lines.join(right, keys, "left").withColumn("__loose", loose)
    aside = F.coalesce((F.col("__right") > 0) & (F.col("x0") > F.col("__right") + 1), F.lit(False))
    bands = lines.where(prose).select(*keys, (F.col("y0") - 2).alias("lo"), (F.col("y1") + 2).alias("hi"))
    inline = placed.where(F.col("__loose") & ~aside)
    floating = outside_bands(inline, bands, keys).select(*keys, "line").withColumn("__floats", F.lit(True))
    kept = placed.where(~(F.col("__loose") & aside)).join(floating, [*keys, "line"], "left").where("__floats IS NULL")
    return kept.select(*lines.columns)


def text_items(lines: DataFrame, page: str, block: str) -> DataFrame:
    """(page, block, y0, text): each block's paragraphs, parted by line feeds; ``y0`` is that of its first line, kept or not."""
    keys = [page, block]
    solid = lines.where(F.trim("text") != "")
    tops = solid.groupBy(*keys).agg(F.min("y0").alias("y0"))
    joined = paragraphs(durable(without_fragments(solid, keys)), keys, ["y0", "line"])
    plain = F.trim("text")
    blocks = joined.where(plain != "").groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para", plain.alias("t")))), lambda x: x["t"]), "\n").alias("text"))
    return blocks.join(tops, keys).select(*keys, "y0", "text")


def drawing_items(drawings: DataFrame, pictures: DataFrame, page: str) -> DataFrame:
    """(page, n, box): drawings that are no rules, merged where they stand near each other, and not covered by a picture."""
    wide, high = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    thin = lambda low: (wide / F.greatest(high, F.lit(1.0)) > WIDE) & (high < low)
    merged = merge_rects(drawings.where((wide >= DRAWING) & (high >= DRAWING) & ~thin(LOW)), page)
    return uncovered(merged.where(~thin(LOW_MERGED)), pictures, page).where((wide >= MERGED[0]) & (high >= MERGED[1]))


def page_items(lines: DataFrame, pictures: DataFrame, drawings: DataFrame, page: str = "page", block: str = "block") -> DataFrame:
    """(page, place, kind, y0, text, width, height): blocks of text (``t``) and figures (``f``) of each page by rounded height, text before figures;
    among equals, blocks in their order, then pictures, then drawings.

    ``lines`` has the columns page, block, line, text, size and a box; ``pictures`` page, n and a box; ``drawings`` page and a box."""
    wide, high = (F.col("x1") - F.col("x0")).alias("width"), (F.col("y1") - F.col("y0")).alias("height")
    large = pictures.where(F.col("x1") - F.col("x0") >= PICTURE)
    texts = text_items(lines, page, block).select(page, F.lit(0).alias("__source"), F.col(block).cast("long").alias("__n"), F.lit("t").alias("kind"), F.col("y0").cast("double").alias("y0"), "text", F.lit(None).cast("double").alias("width"), F.lit(None).cast("double").alias("height"))
    figure = lambda rows, source: rows.select(page, F.lit(source).alias("__source"), F.col("n").cast("long").alias("__n"), F.lit("f").alias("kind"), F.col("y0").cast("double").alias("y0"), F.lit(None).cast("string").alias("text"), wide.cast("double"), high.cast("double"))
    every = texts.unionByName(figure(large, 1)).unionByName(figure(drawing_items(drawings, large, page), 2))
    every = durable(every)  # counted before it is placed
    every = every.withColumns({"__y": F.bround("y0"), "__late": (F.col("kind") != "t").cast("int")})
    return places(every, [page], ["__y", "__late", "__source", "__n"], "place").drop("__source", "__n", "__y", "__late")
