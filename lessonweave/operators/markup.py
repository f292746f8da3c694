"""Classes of lines, answer pairs, spans as html, closures, pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lessonweave.checkpoints import durable, forget


def line_class(text: Column, heads: list[str], boilerplate: list[str]) -> Column:
    """What a line is by how it begins and what it holds; longer headings are tried first."""
    longest_first = "|".join(sorted(heads, key=lambda h: (-len(h), h)))
    junk = reduce(lambda a, b: a | b, [F.contains(text, F.lit(b)) for b in boilerplate], F.length(text) <= 2)
    return (
        F.when(text.rlike(r"^[\s　]*$"), "blank")
        .when(junk, "boilerplate")
        .when(text.rlike("^[0-9０-９]{1,2}[.．、]"), "question")
        .when(text.rlike("^[A-H][.．、]"), "option")
        .when(text.rlike(f"^({longest_first})"), "head")
        .when((F.length(text) < 80) & F.contains(text, F.lit("=")), "equation")
        .otherwise("prose")
    )


def needs_answer_line(text: Column) -> Column:
    return (F.length(text) >= 4) & (text.rlike("[?？]$") | (F.length(text) > 40)) & ~text.rlike("^[A-H][.．]")


def answer_pairs(text: Column) -> Column:
    """``1AB 2C`` as an array of (no, answer); null with fewer than two pairs."""
    pattern = F.lit(r"(\d+)([A-H]+)")
    numbers, letters = F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2))
    return F.when(F.size(numbers) >= 2, F.zip_with(numbers, letters, lambda n, a: F.struct(n.cast("int").alias("no"), a.alias("answer"))))


def spans_to_html(spans: DataFrame, line: str, ratio: float = 0.82, near: float = 1.6) -> DataFrame:
    """Spans (x, size, dy, text) of a line in order; clearly smaller ones are lowered if they stand near the
    base line (``dy``), else raised."""
    big = F.max("size").over(Window.partitionBy(line))
    tag = F.when(F.col("size") / big >= ratio, F.col("text")).when(F.col("dy") <= near, F.concat(F.lit("<sub>"), "text", F.lit("</sub>"))).otherwise(F.concat(F.lit("<sup>"), "text", F.lit("</sup>")))
    marked = spans.select(line, "x", tag.alias("t"))
    return marked.groupBy(line).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "t"))), lambda s: s["t"]), "").alias("html"))


#: So many rounds' new keys are looked up apart before they become one table.
_KEPT_APART = 8


def closure(start: DataFrame, steps: DataFrame) -> DataFrame:
    """Keys that ``steps`` (a, b) reach from ``start`` (k). Only what is new in a round goes on in the next, until nothing is.

    Each round's new keys are written to the checkpoint folder, so that a round reads the tables before it and no plan grows with the number of rounds.
    Joins are by shuffle: a broadcast would bring every round's tables to the driver again.
    """
    steps = durable(steps.where("a IS NOT NULL AND b IS NOT NULL")).hint("merge")
    front = durable(start.where("k IS NOT NULL").distinct())
    parts = [front]
    while not front.isEmpty():
        new = front.join(steps, front["k"] == steps["a"]).select(F.col("b").alias("k")).where("k IS NOT NULL").distinct()
        for part in parts:
            new = new.join(part.hint("merge"), "k", "left_anti")
        front = durable(new)
        parts.append(front)
        if len(parts) > _KEPT_APART:
            whole = durable(reduce(DataFrame.unionByName, parts))
            for part in parts[:-1]:
                forget(part)
            parts = [whole]
    return reduce(DataFrame.unionByName, parts)


def page(title: Column, body: Column) -> Column:
    return F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body>"), body, F.lit("</body></html>"))


def graphic_kind(width: Column, height: Column) -> Column:
    """Images that are too narrow, and rules and ornaments, are told from figures."""
    return F.when(width < 40, "narrow").when((height < 12) | ((width / height > 6) & (height < 45)), "decoration").otherwise("kept")


def strip_option_mark(text: Column) -> Column:
    return F.regexp_replace(text, r"^(<[^>]+>)*[A-H][.．、]\s*", "")
