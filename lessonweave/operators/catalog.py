"""Trees, courses and resources: flattening, first-match joins, picks, first- and last-wins, pairing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    """Null for null and for blank text, so that the two count the same in ``coalesce``."""
    return F.when(F.trim(c) != "", c)


def first_of(*choices: Column) -> Column:
    """The first choice that is neither null nor blank, else the empty text."""
    return F.coalesce(*[blank(c) for c in choices], F.lit(""))


def flatten_tree(roots: DataFrame, node_id: str, title: str, children: str) -> DataFrame:
    """A nested two-level tree as rows (node_id, parent_id, ord, depth, title, node_path).

    ``children`` is an array of structs (id, title) in order; nodes with a blank id are left out.
    """
    top = roots.where(F.trim(F.col(node_id)) != "").select(F.col(node_id).alias("id"), F.col(title).alias("title"), F.col("ord").alias("ord"), F.col(children).alias("kids"))
    first = top.select(F.col("id").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), "ord", F.lit(0).alias("depth"), "title", F.col("id").alias("node_path"))
    below = top.select(F.col("id").alias("parent_id"), F.posexplode("kids").alias("ord", "kid"))
    below = below.where(F.trim(F.col("kid.id")) != "").select(
        F.col("kid.id").alias("node_id"), "parent_id", (F.col("ord") + 1).alias("ord"), F.lit(1).alias("depth"), F.col("kid.title").alias("title"), F.concat_ws("/", "parent_id", "kid.id").alias("node_path")
    )
    return first.unionByName(below)


def first_known_path(courses: DataFrame, chapters: DataFrame, nodes: DataFrame, key: str = "course_id") -> DataFrame:
    """Each course with the first of its ``chapter_paths`` whose head is a known chapter, and the lesson node
    that the path's second part names, if it is known. Courses without such a path are left out.

    Partial aggregation picks the path, so a course with many paths costs one row per task.
    """
    paths = courses.select(key, F.posexplode("chapter_paths").alias("pos", "path"))
    parts = paths.select(key, "pos", F.split("path", "/").alias("p")).select(key, "pos", F.col("p")[0].alias("chapter_id"), F.try_element_at("p", F.lit(2)).alias("node_id"))
    known = parts.join(chapters.select("chapter_id"), "chapter_id", "left_semi")
    chosen = known.groupBy(key).agg(F.min_by(F.struct("chapter_id", "node_id"), "pos").alias("hit"))
    hits = chosen.select(key, "hit.chapter_id", "hit.node_id").join(chapters, "chapter_id")
    return hits.join(nodes, "node_id", "left")


def pick_resource(items: DataFrame, bundle: str, order: str) -> DataFrame:
    """One item per bundle: flags ``href``, ``source``, ``pdf`` in this order, else the first item that is a
    file. The item's first http storage is its url, null if it has none; other items are not tried then."""
    folder_like = F.col("flag").isin("folder", "superboard", "image", "preview", "remarks") | F.col("flag").startswith("thumbnail") | F.col("flag").startswith("ai_")
    rank = F.when(F.col("flag") == "href", 0).when(F.col("flag") == "source", 1).when(F.col("flag") == "pdf", 2).when(~folder_like, 3)
    ranked = items.withColumn("__rank", rank).where(F.col("__rank").isNotNull())
    chosen = ranked.groupBy(bundle).agg(F.min_by(F.struct("flag", "format", "storages"), F.struct("__rank", order)).alias("it"))
    url = F.try_element_at(F.filter("it.storages", lambda s: s.startswith("http")), F.lit(1))
    tail = F.element_at(F.split(F.element_at(F.split("url", r"\?"), 1), r"\."), -1)
    ext = F.when(blank(F.col("it.format")).isNotNull(), F.col("it.format")).when(F.col("url").isNull(), F.lit(None)).when(F.element_at(F.split("url", r"\?"), 1).rlike(r"\.[A-Za-z0-9]{1,5}$"), tail).otherwise(F.lit("bin"))
    return chosen.withColumn("url", url).select(bundle, F.col("it.flag").alias("flag"), "url", ext.alias("ext"))


def pick_video(items: DataFrame, resource: str, wanted: str, fallback_format: str) -> DataFrame:
    """Per resource, the first item of the first bundle that has the wanted flag, else any item of the
    fallback format in that bundle; bundles without either are passed over."""
    rank = F.when(F.col("flag") == wanted, 0).when(F.col("format") == fallback_format, 1)
    usable = items.withColumn("__rank", rank).where(F.col("__rank").isNotNull())
    return usable.groupBy(resource).agg(F.min_by(F.struct("bundle_pos", "item_pos", "url"), F.struct("bundle_pos", "__rank", "item_pos")).alias("v")).select(resource, "v.bundle_pos", "v.item_pos", "v.url")


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; a key's rows are ranked after partial limits per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def last_wins(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("v")).select(*keys, "v.*")


def route_folder(kind: Column, review: Column, chapter_ord: Column, lesson_ord: Column, lesson: Column) -> Column:
    """Where a resource belongs: elite courses, the book's review, a chapter's review, or its lesson."""
    return (
        F.when(kind == "elite_lesson", F.lit("elite"))
        .when(review == "book", F.lit("review_book"))
        .when(review == "chapter", F.concat(F.lit("review_"), (chapter_ord + 1).cast("string")))
        .otherwise(F.concat_ws(".", lesson_ord.cast("string"), lesson))
    )


def pair_by_period(files: DataFrame, keys: list[str], kinds: tuple[str, str]) -> DataFrame:
    """Two kinds of files of the same keys side by side (a full outer pairing), the last of each kind."""
    a, b = kinds
    return files.groupBy(*keys).agg(
        F.max_by(F.when(F.col("kind") == a, F.col("file")), F.when(F.col("kind") == a, F.col("ord"))).alias(a),
        F.max_by(F.when(F.col("kind") == b, F.col("file")), F.when(F.col("kind") == b, F.col("ord"))).alias(b),
    )


def prefix_lookup(wanted: DataFrame, files: DataFrame, kinds: list[str]) -> DataFrame:
    """The first file (by name) that starts with the wanted prefix and contains a kind; later kinds are
    tried only if earlier ones find nothing. Prefixes have any length; an empty one starts every name.

    Each file stands under its own beginning of each length that a prefix has. The best file of a beginning is an aggregate, of which
    every task finds its own first, so that neither pairs nor frequent beginnings gather anywhere.
    """
    lengths = sorted(r[0] for r in wanted.where("prefix IS NOT NULL").select(F.length("prefix")).distinct().collect())  # as many as the longest prefix has characters, at most
    rank = F.coalesce(*[F.when(F.contains("name", F.lit(k)), F.lit(i)) for i, k in enumerate(kinds)])
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("name"))
    begun = files.select("name", rank.alias("__r")).where("__r IS NOT NULL").select("name", "__r", F.explode(sizes).alias("n"))
    best = begun.groupBy(F.left("name", F.col("n")).alias("prefix")).agg(F.min(F.struct("__r", "name")).alias("h"))
    return wanted.join(best, "prefix", "left").select(*wanted.columns, F.col("h.name").alias("name"))


def resume(jobs: DataFrame, done: DataFrame, key: str, least_bytes: int) -> DataFrame:
    """Jobs whose output is missing or too small."""
    return jobs.join(done.where(F.col("bytes") > least_bytes).select(key), key, "left_anti")


def global_places(rows: DataFrame, lead: list[str], last: str, name: str, parts: int = 64) -> DataFrame:
    """Add the places from 1 in the order of the columns ``lead``, of few different values, and ``last``, a number without repeats.

    No task has all rows: they are ranked within ranges of ``last`` with about as many rows each, and shifted by the counts of the
    ranges before; there are ``parts`` ranges for each combination of ``lead``.
    """
    cuts = rows.agg(F.percentile_approx(last, [k / parts for k in range(1, parts)])).first()[0] or []
    kind = rows.schema[last].dataType
    cuts = F.array(*[F.lit(x).cast(kind) for x in sorted(set(cuts))])
    dealt = rows.withColumn("__range", F.size(F.filter(cuts, lambda x: x < F.col(last))))
    keys = [*lead, "__range"]
    ahead = F.coalesce(F.sum("__n").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).withColumn("__ahead", ahead).drop("__n")
    ranked = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(last)))
    return ranked.join(counts, keys).withColumn(name, F.col("__rank") + F.col("__ahead")).drop("__range", "__rank", "__ahead")
