"""Queries of the engine's own operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lessonweave.plans import answer_queries, catalog_queries, lesson_queries, line_queries, markup_queries, math_queries, page_queries, section_queries, sequence_queries, text_queries

_FAMILIES = [answer_queries, catalog_queries, text_queries, sequence_queries, markup_queries, math_queries, lesson_queries, section_queries, page_queries, line_queries]

QUERIES = {name: f for family in _FAMILIES for name, f in family.QUERIES.items()}
ORACLE_SQL = {name: sql for family in _FAMILIES for name, sql in family.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["qa_booklet_pages"](spark, sf_dir)
