"""Sections on pages: those that would begin in a page's lower half begin the next page, round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.checkpoints import durable, forget
from lessonweave.operators.scans import in_ranges, prefix_scan

#: Fixed value: so many rounds at most.
ROUNDS = 5


def laid_out(sections: DataFrame, doc: str, order: str, page: int, cut: bool) -> DataFrame:
    """Sections with ``page`` and ``top``, the height at which they begin there. One that ``breaks`` begins a page; all others follow
    the one before. Sections have ``height`` and ``__range``.

    Between breaks, heights add up; before them, every run of sections fills its pages."""
    run = F.col("breaks").cast("int")
    summed = prefix_scan(sections, [doc], order, sums={"__run": run, "__end": F.col("height")}, cut=cut)
    begins = F.when(F.col("breaks"), F.struct((F.col("__end") - F.col("height")).alias("at")))
    filled = prefix_scan(summed, [doc], order, lasts={"__since": begins}, cut=cut)
    filled = filled.withColumn("__off", F.col("__end") - F.col("height") - F.coalesce("__since.at", F.lit(0)))
    # A run's height is known where the next one begins: there, its pages are added.
    before = prefix_scan(filled, [doc], order, lags={"__was": F.col("__off") + F.col("height")}, cut=cut)
    pages = F.when(F.col("breaks"), F.ceil(F.coalesce("__was", F.lit(0)) / page))
    based = prefix_scan(before, [doc], order, sums={"__base": pages}, cut=cut)
    kept = [c for c in sections.columns if c not in ("page", "top")]
    return based.select(*kept, (F.col("__base") + F.floor(F.col("__off") / page)).alias("page"), (F.col("__off") % page).alias("top"))


def paginate_by_title(sections: DataFrame, doc: str, order: str, page: int, rounds: int = ROUNDS) -> DataFrame:
    """``sections`` (title, height) with ``page``, ``top`` and ``breaks``.

    In each round, sections that begin in the lower half of a page join the growing set of those that begin a page, by title and occurrence; it ends when
    none does, or after ``rounds``. Sections with equal titles are told apart by their occurrence, which is what a layout that knows only titles has."""
    ranged, cut = in_ranges(sections, [doc], order)
    numbered, title_cut = in_ranges(ranged.withColumn("__doc_range", F.col("__range")).drop("__range"), [doc, "title"], order)
    numbered = prefix_scan(numbered, [doc, "title"], order, sums={"occurrence": F.lit(1)}, cut=title_cut).withColumn("__range", F.col("__doc_range")).drop("__doc_range")
    now = durable(laid_out(numbered.withColumns({"occurrence": F.col("occurrence") - 1, "breaks": F.lit(False)}), doc, order, page, cut))
    for _ in range(rounds):
        low = (F.col("top") * 2 > page) & ~F.col("breaks")
        if now.where(low).isEmpty():
            break
        before, now = now, durable(laid_out(now.withColumn("breaks", F.col("breaks") | low), doc, order, page, cut))
        forget(before)
    return now.drop("__range")
