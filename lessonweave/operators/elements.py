"""Elements of markup as rows: tags by place, nesting by running depth, slices that stay balanced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.operators.scans import RANGE, in_ranges, prefix_scan

#: Elements that have no end tag.
VOID = "area base br col embed hr img input link meta source track wbr".split()
#: A task's share, which does not grow with the input.
TASK_ROWS, TASK_CHARS = 200_000, 32_000_000
TAG = r"<\s*/?\s*[A-Za-z][A-Za-z0-9]*[^>]*>"


def tags(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, name, closes, start, stop) of each tag of an element that can hold something, places from 0, ``stop`` behind the tag.

    Markup is parted at its tags; where a tag stands is a running sum of lengths."""
    return _tags(pages, key, html)[0]


def _tags(pages: DataFrame, key: str, html: str) -> tuple[DataFrame, bool]:
    """The tags, and whether markup was cut into ranges."""
    names = F.regexp_extract_all(html, F.lit(TAG), F.lit(0))
    rows = pages.select(key, F.posexplode(F.arrays_zip(F.slice(F.split(html, TAG, -1), F.lit(1), F.size(names)).alias("gap"), names.alias("tag"))).alias("pos", "x"))
    ranged, cut = in_ranges(rows.select(key, "pos", "x.*"), [key], "pos")
    placed = prefix_scan(ranged, [key], "pos", sums={"stop": F.length("gap") + F.length("tag")}, cut=cut)
    name = F.lower(F.regexp_extract("tag", "([A-Za-z][A-Za-z0-9]*)", 1))
    found = placed.select(key, "pos", name.alias("name"), F.col("tag").rlike(r"^<\s*/").alias("closes"), (F.col("stop") - F.length("tag")).alias("start"), "stop", F.col("tag").rlike(r"/\s*>$").alias("alone"))
    return found.where(~F.col("name").isin(VOID) & ~F.col("alone")).drop("alone"), cut


def elements(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, name, n, depth, start, inner, end_tag, stop) of each closed element: its number among those of its name, from 0, how many of them hold it
    (it included), where its start tag begins and stops, and where its end tag does. End tags with nothing to close are passed over.

    The depth of a name is a running sum that never falls below 0. At one depth, start and end tags take turns, so that
    the tag before an end tag is what it closes."""
    by_name = [key, "name"]
    t, large = _tags(pages, key, html)
    whole = lambda rows, part: in_ranges(rows, part, "pos") if large else (rows.withColumn(RANGE, F.lit(0)), False)
    t, cut = whole(t, by_name)
    step = F.when(F.col("closes"), -1).otherwise(1)
    summed = prefix_scan(t, by_name, "pos", sums={"level": step, "__starts": (~F.col("closes")).cast("int")}, cut=cut)
    floored = prefix_scan(summed, by_name, "pos", highs={"__under": -F.col("level")}, cut=cut).withColumn("level", F.col("level") + F.greatest("__under", F.lit(0)))
    before = prefix_scan(floored, by_name, "pos", lags={"__was": F.col("level")}, cut=cut)
    depth = F.when(F.col("closes"), F.coalesce("__was", F.lit(0))).otherwise(F.col("level"))
    at_depth = before.withColumn("depth", depth).where("depth > 0").select(key, "name", "pos", "closes", "depth", "start", "stop", (F.col("__starts") - 1).alias("n"))
    opened = F.when(~F.col("closes"), F.struct("n", "start", F.col("stop").alias("inner")))
    part = [key, "name", "depth"]
    at_depth, cut = whole(at_depth, part)
    paired = prefix_scan(at_depth, part, "pos", lags={"o": opened}, cut=cut)
    return paired.where(F.col("closes") & F.col("o").isNotNull()).select(key, "name", "o.n", "depth", "o.start", "o.inner", F.col("start").alias("end_tag"), "stop")


def _dealt(rows: DataFrame, key: str, html: str) -> DataFrame:
    """``rows`` by key, in as many tasks as keep each to so many rows and characters; scans and joins by the key find them there."""
    told = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length(html)).alias("chars")).first()
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-told["rows"] // TASK_ROWS), -(-(told["chars"] or 0) // TASK_CHARS))
    return rows.repartition(tasks, key)


def balanced(slices: DataFrame, key: str, html: str, start: str, end: str) -> DataFrame:
    """(key, html): the markup from ``start`` to ``end``, with start tags for elements that are open at its beginning and end tags for
    those that are open at its end, outer ones first and last. Null markup is null; a slice that ends before it begins is empty."""
    given = _dealt(slices.select(key, F.col(html).alias("__html"), F.col(start).alias("__a"), F.col(end).alias("__b")), key, "__html")
    spans = elements(given, key, "__html").join(given.select(key, "__a", "__b"), key)
    holds = lambda at: (F.col("start") < F.col(at)) & (F.col("end_tag") >= F.col(at))
    around = spans.where(holds("__a") | holds("__b")).groupBy(key)  # as many as elements are nested
    own = lambda at: F.array_sort(F.collect_list(F.when(holds(at), F.struct("start", "name"))))
    open_ones = around.agg(own("__a").alias("__before"), own("__b").alias("__after"))
    none = F.array().cast("array<struct<start:bigint,name:string>>")
    joined = given.join(open_ones, key, "left").withColumns({c: F.coalesce(c, none) for c in ("__before", "__after")})
    cut = F.substr("__html", F.col("__a") + 1, F.col("__b") - F.col("__a"))
    tag = lambda left: lambda e: F.concat(F.lit(left), e["name"], F.lit(">"))
    text = F.concat(F.array_join(F.transform("__before", tag("<")), ""), cut, F.array_join(F.transform(F.reverse("__after"), tag("</")), ""))
    return joined.select(key, F.when(F.col("__a") >= F.col("__b"), F.when(F.col("__html").isNotNull(), "")).otherwise(text).alias("html"))


def with_formulas(rows: DataFrame, key: str, text: str, to_html, escape) -> DataFrame:
    """(key, html): text as html in which what stands between dollars, up to 200 characters, is a formula; a text without dollars that has a command is one formula.
    ``to_html`` makes an array of formulas into one of their html and ``escape`` is a column function. Rows stay where they are: nothing is dealt by key or formula."""
    t = F.coalesce(F.col(text), F.lit(""))
    span = r"\$([^$]{1,200})\$"
    whole = ~F.contains(t, F.lit("$")) & t.rlike(r"\\[a-zA-Z]{2,}")
    parted = rows.select(
        key, F.when(whole, F.array(F.lit(""))).otherwise(F.split(t, span, -1)).alias("__texts"), F.when(whole, F.array(t)).otherwise(F.regexp_extract_all(t, F.lit(span), F.lit(1))).alias("__tex"),
    )
    made = parted.withColumn("__made", to_html(F.col("__tex")))
    formula = lambda i: F.when(F.coalesce(F.get("__made", i), F.lit("")) != "", F.concat(F.lit('<span class="m">'), F.get("__made", i), F.lit("</span>"))).otherwise("")
    return made.select(key, F.array_join(F.transform("__texts", lambda x, i: F.concat(escape(x), formula(i))), "").alias("html"))


def outermost(spans: DataFrame, key: str) -> DataFrame:
    """Of the elements, those that no other of the given ones holds: blocks that stand apart."""
    scanned = prefix_scan(spans, [key], ["start", "stop"], highs={"__reached": F.col("stop")})
    before = prefix_scan(scanned, [key], ["start", "stop"], lags={"__before": F.col("__reached")})
    return before.where(F.col("__before").isNull() | (F.col("__before") < F.col("stop"))).select(*spans.columns)


def without(pages: DataFrame, key: str, html: str, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, html) without the outermost of the spans, and (key, n, html) of these, in order: blocks isolated from their surroundings."""
    blocks = outermost(spans, key)
    listed = blocks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("__cuts"))
    own = pages.select(key, html).join(listed, key, "left")
    length = F.length(html).cast("long")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("__cuts", lambda c: c["stop"]))
    stops = F.concat(F.transform("__cuts", lambda c: c["start"]), F.array(length))
    kept = F.array_join(F.zip_with(starts, stops, lambda a, b: F.substr(F.col(html), a.cast("int") + 1, (b - a).cast("int"))), "")
    rest = own.select(key, F.when(F.col("__cuts").isNull(), F.col(html)).otherwise(kept).alias("html"))
    taken = own.where("__cuts IS NOT NULL").select(key, html, F.posexplode("__cuts").alias("n", "c"))
    return rest, taken.select(key, "n", F.substr(F.col(html), F.col("c.start").cast("int") + 1, (F.col("c.stop") - F.col("c.start")).cast("int")).alias("html"))
