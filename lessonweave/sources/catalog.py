"""Readers and writers of nested catalogs, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESOURCE = "struct<type:string,type_name:string,period:string,file:string,url:string,ext:string,status:string,local:string>"
CATALOG = f"chapter string, chapter_id string, book string, lessons array<struct<lesson_no:string,lesson:string,activity_id:string,chapter_node:string,resources:array<{RESOURCE}>>>"
NODE = "id string, title string, node_path string"
TREE = f"{NODE}, child_nodes array<struct<id:string,title:string,node_path:string>>"
COURSE_ITEM = "struct<ti_file_flag:string,ti_format:string,ti_storages:array<string>>"
COURSE = f"course_id string, relations struct<national_course_resource:array<struct<resource_type_code:string,global_title:map<string,string>,ti_items:array<{COURSE_ITEM}>>>>"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object or array per file; keys that are absent are null; ``file`` is the source and gives the order."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("file", F.col("_metadata.file_path"))


def catalog_resources(catalog: DataFrame) -> DataFrame:
    """One row per resource. Lesson numbers repeat, so the position is what tells lessons apart."""
    lessons = catalog.select("book", "chapter", F.posexplode("lessons").alias("lesson_pos", "l"))
    rows = lessons.select("book", "chapter", "lesson_pos", F.col("l.lesson").alias("lesson"), F.posexplode("l.resources").alias("pos", "r"))
    return rows.select("book", "chapter", "lesson_pos", "lesson", "pos", "r.*")


def course_items(courses: DataFrame) -> DataFrame:
    """(course_id, bundle_pos, item_pos, flag, format, storages) of each item of each bundle."""
    bundles = courses.select("course_id", F.posexplode("relations.national_course_resource").alias("bundle_pos", "b"))
    items = bundles.select("course_id", "bundle_pos", F.posexplode("b.ti_items").alias("item_pos", "i"))
    return items.select("course_id", "bundle_pos", "item_pos", F.col("i.ti_file_flag").alias("flag"), F.col("i.ti_format").alias("format"), F.col("i.ti_storages").alias("storages"))


def write_sections(sections: DataFrame, path: str, lesson: str = "lesson_id") -> None:
    """Sections as JSON, one folder per lesson; what was there is replaced."""
    sections.write.mode("overwrite").partitionBy(lesson).json(path)


def listing(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Names and sizes of files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))
