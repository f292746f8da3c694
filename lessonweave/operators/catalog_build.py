"""A catalog in one job: courses to lessons, bundles to files, and nested JSON by chapter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.operators.catalog import first_known_path, first_wins, pick_resource
from lessonweave.operators.scans import places

#: Resources of a lesson in one row at most; a lesson with more has several rows.
MOST = 1_000
RESOURCE = "struct<place:bigint,file:string,url:string,ext:string,period:string>"
CATALOG = f"lesson_id string, lesson string, part long, resources array<{RESOURCE}>, chapter string, chapter_id string"


def catalog_rows(courses: DataFrame, chapters: DataFrame, nodes: DataFrame, bundles: DataFrame, items: DataFrame) -> DataFrame:
    """(chapter_id, chapter, lesson_id, lesson, bundle, period, file, url, ext): each file of the catalog once.

    A course stands in the lesson that its first known path names, or in its chapter alone. Of a bundle, one item is picked; bundles whose item has no url are left
    out. A file is named by its bundle's ``name``, after its period where the course has several. Of files with one name in one
    lesson, the first bundle's stays."""
    placed = first_known_path(courses, chapters, nodes).select("course_id", "chapter_id", "chapter", F.col("node_id").alias("__node"), "lesson")
    placed = placed.withColumn("lesson_id", F.when(F.col("lesson").isNotNull(), F.col("__node"))).drop("__node")
    picked = pick_resource(items, "bundle", "pos").where("url IS NOT NULL").select("bundle", "url", "ext")
    found = bundles.join(picked, "bundle")
    several = found.groupBy("course_id").agg((F.min("period") != F.max("period")).alias("several"))
    named = found.join(several, "course_id").join(placed, "course_id")
    file = F.concat(F.when(F.col("several"), F.concat("period", F.lit("-"))).otherwise(""), "name", F.lit("."), "ext")
    rows = named.select("chapter_id", "chapter", "lesson_id", "lesson", "bundle", "period", file.alias("file"), "url", "ext")
    return first_wins(rows, ["chapter_id", "lesson_id", "file"], ["bundle"])


def write_catalog(rows: DataFrame, path: str, most: int = MOST) -> None:
    """Lessons with their resources in order, as JSON in a folder for each chapter. No row holds more than ``most`` resources, and no task a chapter: rows are dealt by
    lesson and part."""
    placed = places(rows, ["chapter_id", "lesson_id"], ["bundle", "file"], "place")
    resource = F.struct("place", "file", "url", "ext", "period")
    parts = placed.withColumn("part", F.floor((F.col("place") - 1) / most)).groupBy("chapter_id", "chapter", "lesson_id", "lesson", "part")
    nested = parts.agg(F.array_sort(F.collect_list(resource)).alias("resources"))
    nested.select("lesson_id", "lesson", "part", "resources", "chapter", "chapter_id").write.mode("overwrite").partitionBy("chapter_id").json(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(chapter_id, chapter, lesson_id, lesson, part, place, file, url, ext, period) of a written catalog; one chapter is read by its folder alone."""
    lessons = spark.read.schema(CATALOG).json(path)
    return lessons.select("chapter_id", "chapter", "lesson_id", "lesson", "part", F.explode("resources").alias("r")).select("chapter_id", "chapter", "lesson_id", "lesson", "part", "r.*")


def lesson_lists(rows: DataFrame, key: list[str], text: str, order: list[str], most: int = MOST, sep: str = ",") -> DataFrame:
    """(key, part, n, listing): texts of each key in order, joined by ``sep``, at most ``most`` in a row."""
    placed = places(rows, key, order, "__place")
    parts = placed.withColumn("part", F.floor((F.col("__place") - 1) / most)).groupBy(*key, "part")
    listing = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__place", text))), lambda x: x[text]), sep)
    return parts.agg(F.count(F.lit(1)).alias("n"), listing.alias("listing"))


def chapter_rollup(chapters: DataFrame, lessons: DataFrame, resources: DataFrame, most: int = MOST) -> DataFrame:
    """(chapter, lessons, resources, listing) of each chapter (chapter_id, chapter), those without lessons (chapter_id, lesson_id, lesson) too: how many lessons and
    resources (lesson_id, pos, name) it has, and ``lesson:name;name`` of its lessons by id, parted by bars.

    Names are put in order and joined by ``most`` in many tasks; only these pieces, which are what the chapter's row holds in the end, meet by lesson and chapter."""
    counts = resources.groupBy("lesson_id").agg(F.count(F.lit(1)).alias("__n"))
    pieces = lesson_lists(resources.where("name IS NOT NULL"), ["lesson_id"], "name", ["pos"], most, ";")
    in_order = lambda key, text, sep: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, text))), lambda x: x[text]), sep)
    names = pieces.groupBy("lesson_id").agg(in_order("part", "listing", ";").alias("__names"))
    known = lessons.join(counts, "lesson_id", "left").join(names, "lesson_id", "left")
    line = F.concat("lesson", F.lit(":"), F.coalesce("__names", F.lit("")))
    known = known.select("chapter_id", "lesson_id", F.coalesce("__n", F.lit(0)).alias("__n"), line.alias("__line"))
    found = known.groupBy("chapter_id").agg(F.count("lesson_id").alias("__lessons"), F.sum("__n").alias("resources"), in_order("lesson_id", "__line", "|").alias("listing"))
    joined = chapters.join(found, "chapter_id", "left")
    return joined.select("chapter", F.coalesce("__lessons", F.lit(0)).alias("lessons"), "resources", "listing")
