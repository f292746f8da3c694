"""Editions of a sectioned document: for students, for teachers, and the answers alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.checkpoints import durable
from lessonweave.operators.answers import answer_lines
from lessonweave.operators.lines import has_option
from lessonweave.operators.sectioning import answer_sections, answers, paragraphs, sections

#: Fixed value: what stands for an answer to a task that has none.
OPEN_TASK = "（开放性任务，答案略）"


def _bodies(decided: DataFrame) -> DataFrame:
    """(doc, sid, body, options, chars) of each section's paragraphs and tables."""
    own = paragraphs(decided)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "pos", "value"))), lambda x: x["value"]), "\n")
    return own.groupBy("doc", "sid").agg(text.alias("body"), F.bool_or(has_option(F.col("value"))).alias("options"), F.sum(F.length("value")).alias("chars"))


def _with_answers(questions: DataFrame, found: DataFrame) -> DataFrame:
    """Questions with the answer of their group and number, else that of their number in no group."""
    line = F.concat(F.lit("【"), "tag", F.lit("】"), "text")
    exact = found.where(F.trim("text") != "").select("doc", "grp", "no", line.alias("__exact"))
    plain = exact.where("grp = 0").select("doc", "no", F.col("__exact").alias("__plain"))
    joined = questions.join(exact, ["doc", "grp", "no"], "left").join(plain, ["doc", "no"], "left")
    return joined.withColumn("line", F.coalesce("__exact", "__plain")).drop("__exact", "__plain")


def edition(decided: DataFrame, mode: str) -> DataFrame:
    """(doc, part, place, sub, line) of an edition, in order of part, place and sub.

    ``student``: titles (sub 0) and texts (1) of all sections, and room for an answer (2) after questions without options, by their length.
    ``teacher``: the same with the answer in place of the room. ``answer``: a notice for each task, then, as part 1, the answers by group and number."""
    if mode not in ("student", "teacher", "answer"):
        raise ValueError(mode)
    decided = durable(decided)  # read several times below
    found = answer_sections(answers(decided))
    every = sections(decided)
    if mode == "answer":
        tasks = every.where("kind = 'task'").select("doc", F.lit(0).alias("part"), F.col("sid").alias("place"), F.lit(1).alias("sub"), F.lit(OPEN_TASK).alias("line"))
        listed = found.select("doc", F.lit(1).alias("part"), "place", F.lit(0).alias("sub"), F.concat("title", F.lit("　"), "text").alias("line"))
        return tasks.unionByName(listed)
    bodies = every.join(_bodies(decided), ["doc", "sid"], "left")
    title = F.when(F.col("kind") == "q", F.concat(F.col("no").cast("string"), F.lit("．"))).otherwise(F.col("title"))
    if mode == "student":
        last = F.when(~F.coalesce("options", F.lit(False)), F.repeat(F.lit("_"), answer_lines(F.coalesce("chars", F.lit(0)))))
    else:
        bodies, last = _with_answers(bodies, found), F.col("line")  # sections that are no questions have no number
    shown = [title, F.col("body"), F.when(F.col("kind") == "q", last)]
    rows = bodies.select("doc", "sid", F.explode(F.array(*[F.struct(F.lit(sub).alias("sub"), line.alias("line")) for sub, line in enumerate(shown)])).alias("x"))
    return rows.select("doc", F.lit(0).alias("part"), F.col("sid").alias("place"), "x.sub", "x.line").where("line IS NOT NULL")
