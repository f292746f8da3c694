"""Questions and answers: attaching, pairing through keyed and fallback lookups, editions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.operators.scans import prefix_scan


def number_questions(turns: DataFrame, doc: str, order: str, is_question: Column) -> DataFrame:
    """``no``: the running number of the question that a row belongs to; rows before the first question
    belong to it too (a pending head). Null in documents without a question."""
    found = prefix_scan(turns, [doc], order, sums={"__run": is_question.cast("int")}, firsts={"__any": F.when(is_question, 1)})
    return found.withColumn("no", F.when(F.col("__any") == 1, F.greatest("__run", F.lit(1)))).drop("__run", "__any")


def attach_to_number(rows: DataFrame, doc: str, order: str, number: str) -> DataFrame:
    """Forward fill of ``number``; rows before the first number go to that first number."""
    found = prefix_scan(rows, [doc], order, lasts={"owner": F.col(number)}, firsts={"__first": F.col(number)})
    return found.withColumn("owner", F.coalesce("owner", "__first")).drop("__first")


def joined_text(text: Column, order: Column, sep: str) -> Column:
    """Texts of a group in order, as an aggregate."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t")))), lambda x: x["t"]), sep)


def edition_rows(pairs: DataFrame, mode: str) -> DataFrame:
    """The lines (doc, no, sub, line) of an edition: students get questions and room for an answer,
    teachers both, the answer key answers alone. ``pairs`` has doc, no, question, answer."""
    ask = pairs.select("doc", "no", F.lit(0).alias("sub"), F.concat(F.col("no").cast("string"), F.lit("．"), F.col("question")).alias("line"))
    tell = pairs.where("answer <> ''").select("doc", "no", F.lit(1).alias("sub"), F.concat(F.lit("【答案】"), F.col("answer")).alias("line"))
    room = pairs.select("doc", "no", F.lit(1).alias("sub"), F.repeat(F.lit("_"), answer_lines(F.length("question"))).alias("line"))
    if mode == "student":
        return ask.unionByName(room)
    return ask.unionByName(tell) if mode == "teacher" else tell


def answer_lines(n: Column) -> Column:
    """Lines of room for an answer to a question of so many characters."""
    return F.when(n <= 130, 3).when(n <= 230, 4).otherwise(6)


def double_lookup(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """``body`` by (doc, no, grp), else by (doc, no) with group 0; blank bodies count as missing.

    Both lookups are one pass: the answers of a number are gathered once and the better one is chosen.
    """
    usable = answers.where(F.trim("body") != "")
    exact = usable.groupBy("doc", "no", "grp").agg(F.min("body").alias("exact"))
    plain = usable.where("grp = 0").groupBy("doc", "no").agg(F.min("body").alias("plain"))
    found = questions.join(exact, ["doc", "no", "grp"], "left").join(plain, ["doc", "no"], "left")
    return found.withColumn("body", F.coalesce("exact", "plain")).drop("exact", "plain")


def remap_numbers(rows: DataFrame, remap: DataFrame) -> DataFrame:
    """Rewrite ``no`` where ``remap`` (doc, no, grp, new_no) has an entry."""
    keys = ["doc", "no", "grp"]
    return rows.join(remap, keys, "left").withColumn("no", F.coalesce("new_no", "no")).drop("new_no")


def match_library(tasks: DataFrame, library: DataFrame, cues: DataFrame) -> DataFrame:
    """The curated answer of each task (lesson, title, body): entries of the lesson whose title is the task's
    or starts with it and ``·``; among several the first whose cue word is in the body, then the first
    with the word "example", then the first by ``ord``."""
    parts = F.split("entry", "·")
    names = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "·"))
    known = library.select("lesson", "entry", "ord", "answer", F.explode(F.array_distinct(names)).alias("title"))
    # Of the entries of a lesson and title, only the best one counts without a cue, and the best one of each cue.
    rank = F.when(F.contains("entry", F.lit("example")), 1).otherwise(2)
    usual = known.groupBy("lesson", "title").agg(F.min(F.struct(rank.alias("r"), "ord", "answer")).alias("usual"))
    cued = known.join(cues, "entry").groupBy("lesson", "title", "cue").agg(F.min(F.struct(F.lit(0).alias("r"), "ord", "answer")).alias("cued"))
    heard = tasks.join(cued, ["lesson", "title"]).where(F.contains("body", "cue")).groupBy("task").agg(F.min("cued").alias("cued"))
    best = F.coalesce("cued", "usual")["answer"]
    return tasks.join(usual, ["lesson", "title"], "left").join(heard, "task", "left").select("task", "lesson", "title", best.alias("answer"))


def upsert(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both; where both have a key, the second's row stays."""
    a, b = first.withColumn("__src", F.lit(0)), second.withColumn("__src", F.lit(1))
    values = [c for c in first.columns if c not in keys]
    return a.unionByName(b).groupBy(*keys).agg(F.max_by(F.struct(*values), "__src").alias("v")).select(*keys, "v.*")
