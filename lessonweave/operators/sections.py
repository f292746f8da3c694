"""Blocks to sections: windowed parsers for documents with headings, and a fold for the full state machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.operators.scans import prefix_scan


def forward_sections(blocks: DataFrame, doc: str, order: str, is_head: Column, title: Column) -> DataFrame:
    """Each block with the section (``sid`` from 1, ``title``) of the last heading; 0 stands before the first."""
    return prefix_scan(blocks, [doc], order, sums={"sid": F.when(is_head, 1).otherwise(0)}, lasts={"title": F.when(is_head, title)})


def answer_zone(blocks: DataFrame, doc: str, order: str, is_start: Column) -> DataFrame:
    """``zone``: ``ans`` for blocks at or after the first start, else ``q``."""
    found = prefix_scan(blocks, [doc], order, highs={"__started": is_start.cast("int")})
    return found.withColumn("zone", F.when(F.col("__started") == 1, "ans").otherwise("q")).drop("__started")


#: What a block begins with.
HEADINGS = r"^(学习目标|课前学习任务|课上学习任务|课后练习答案|课后练习|参考答案|推荐的学习资源)"
TASK = r"^【?学习任务([一二三四五六七八九十]+)】?"
NUMBER = r"^([0-9０-９]{1,2})(?:\.(?![0-9])|[．、])"
OPTION = r"^([A-H])[.．、]"
ANSWER = r"^【?(答案|解析|参考答案)】?[:：]?"


def sectionize(blocks: DataFrame) -> DataFrame:
    """Blocks (doc, idx, text) to (doc, idx, sid, kind, title, no, grp): headings ``h``, tasks ``task``, questions
    ``q``, their answers ``ans``, and ``pre`` before everything.

    What a block is depends on what was decided before it (answer mode, the current question, its group),
    so this is a fold. Blocks reach a task sorted by document and stream through it; the state is a few
    values, whatever a document's size.
    """
    import re

    heading, task, number, option, answer = (re.compile(p) for p in (HEADINGS, TASK, NUMBER, OPTION, ANSWER))
    digits = str.maketrans("０１２３４５６７８９", "0123456789")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, state = object(), {}
        for batch in batches:
            out: list[tuple] = []
            for d, idx, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if d != doc:
                    doc, state = d, {"sid": 0, "kind": "pre", "title": None, "no": None, "grp": 0, "answers": False}
                t = (text or "").strip()
                if m := heading.match(t):
                    if "练习" in m[1] and not m[1].endswith("答案"):
                        state["grp"] += 1
                    state |= {"sid": state["sid"] + 1, "kind": "h", "title": m[1], "no": None, "answers": m[1].endswith("答案")}
                elif m := task.match(t):
                    state |= {"sid": state["sid"] + 1, "kind": "task", "title": m[0], "no": None, "answers": False}
                elif m := number.match(t):
                    state |= {"sid": state["sid"] + 1, "kind": "ans" if state["answers"] else "q", "title": None, "no": int(m[1].translate(digits))}
                elif (m := answer.match(t)) and state["no"] is not None:
                    state |= {"sid": state["sid"] + 1, "kind": "ans", "title": m[1]}
                elif option.match(t) and state["kind"] == "ans" and not state["answers"]:
                    state |= {"sid": state["sid"] + 1, "kind": "q", "title": None}
                out.append((d, idx, state["sid"], state["kind"], state["title"], state["no"], state["grp"]))
            if out:
                types = [batch.schema.field(0).type, batch.schema.field(1).type, *added.values()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    added = {"sid": pa.int32(), "kind": pa.string(), "title": pa.string(), "no": pa.int32(), "grp": pa.int32()}
    schema = blocks.select("doc", "idx", *[F.lit(None).cast("int" if t == pa.int32() else "string").alias(n) for n, t in added.items()]).schema
    names = schema.names
    return blocks.select("doc", "idx", "text").repartition("doc").sortWithinPartitions("doc", "idx").mapInArrow(run, schema)


def paginate(sections: DataFrame, doc: str, order: str, height: str, page: int) -> DataFrame:
    """Page numbers by cumulative height. A section that would be cut by a page's end is moved to the next
    page, which moves all that follow; one higher than a page stays where it begins. A section without a
    height has no page.

    Where a section begins depends on all moves before it, so this is a fold. Sections reach a task sorted by
    document and stream through it; the state is the height used so far.
    """
    at, by = sections.columns.index(doc), sections.columns.index(height)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, top = object(), 0
        for batch in batches:
            pages: list[int | None] = []
            for d, h in zip(batch.column(at).to_pylist(), batch.column(by).to_pylist(), strict=True):
                if d != now:
                    now, top = d, 0
                if h is None:
                    pages.append(None)
                    continue
                if h <= page < top % page + h:
                    top += page - top % page
                pages.append(int(top // page))
                top += h
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pages, pa.int64())], names=names)

    schema = sections.withColumn("page", F.lit(None).cast("long")).schema
    names = schema.names
    return sections.repartition(doc).sortWithinPartitions(doc, order).mapInArrow(run, schema)
