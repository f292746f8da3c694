"""Blocks of lesson documents to sections, questions and answers.

What a block is depends on what was decided before it: whether answers are being read, which question is open, which
numbers have an answer. Everything that doesn't, namely patterns, marks, what follows a block, the kind of document, is
columns computed by Spark before; what comes after the decisions (section numbers, texts, answers, figures) is
joins and scans again. Between them stands one small machine with a state of a few values. It reads a task's documents as a
sorted stream. A document too large for a task is cut into ranges, whose machines begin with a guess; ranges whose
guess turns out not to be what the range before ended with run again, until none is left.

Defined cases: blocks have ``doc``, ``idx`` (a number, unique in a document), ``kind`` (``p`` or ``table``), ``text``
and ``figures`` (array of names); null text is empty, a null kind is ``p``, null figures are none. Full-width digits and letters
count as their plain forms.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lessonweave.checkpoints import durable, forget
from lessonweave.operators.scans import LEAST_ROWS, RANGE, following, in_ranges, prefix_scan

#: Titles of sections and the context that each opens.
TITLES = {
    "学习目标": "list", "课前学习任务": "list", "课上学习任务": "task", "课后练习": "exercise", "课后作业": "exercise", "课堂探究": "task",
    "自我测评": "exercise", "学习目标与任务": "list", "推荐的学习资源": "list", "课程基本信息": "list", "课后练习答案": "answer",
}
_LONGEST_FIRST = "|".join(sorted(TITLES, key=lambda t: (-len(t), t)))
#: Lines that every document has and no section keeps; lines above the first section.
BOILERPLATE = r"^(课程基本信息|课题|教科书|书名[:：]|出版社[:：]|出版日期|学生信息|姓名|学校|班级|学号|推荐的学习资源)$"
ABOVE = r"^(深圳外国语学校博雅高中|必修三|必修第三册|深外博雅|姓名[:：]|班级[:：]|第[一二三四五六七八九十]+章|学习目标与任务$)"

_S = r"[\s\x{3000}]"
_N, _L = "[0-9０-９]{1,2}", "[A-DＡ-Ｄ]"
_NO = rf"^({_N}){_S}*[.．、]{_S}*(?=[^\s\x{{3000}}])"
_OPTION = rf"^({_L}){_S}*[.．、]{_S}*[^\s\x{{3000}}]"
_ANSWER_HEAD = r"^(?:【[^】]*答案[^】]*】|参考答案|答案)"
_ANSWER_NO = rf"^({_N}){_S}*[.．、]?{_S}*(?:【[^】]*答案[^】]*】|参考答案|答案){_S}*[:：]?{_S}*"
_EXPLAIN = rf"^(?:【[^】]*解析[^】]*】|解析|详解|点拨){_S}*[:：]?{_S}*"
_TITLE = rf"^[\[【]?{_S}*({_LONGEST_FIRST}){_S}*[\]】]?{_S}*"
_TASK = rf"^(?:【{_S}*学习任务[^】]*】|【{_S}*目标[^】]*】|【{_S}*判断正误{_S}*】)"
_PIECE = rf"^《[^》]{{1,20}}》{_S}*【[^】]{{2,8}}】"
_DIVIDER = r"^【[^】]{2,10}】.{0,40}$"
_PAREN = rf"^[（(]{_S}*{_N}{_S}*[）)]"
_FIRST_PAREN = rf"^[（(]{_S}*[1１]{_S}*[）)]"
_BRACKET_NO = rf"^[\[【][^】]{{1,12}}[\]】]{_S}*{_N}{_S}*[.．、]"
#: Words that begin a derivation.
_DERIVES = "由 因 根据 解 答 故 选 设 当 若 则".split()
#: A number within a list of answers: after white space, and no decimal point unless it is a full-width one.
MARK = rf"(?=[0-9０-９])(?<![^\s\x{{3000}}])({_N})(?:\.(?![0-9０-９])|[．、])(?={_S}*[^\s\x{{3000}}])"
PAIR = rf"({_N}){_S}*({_L}{{1,4}})(?![A-Za-z0-9])"
_EVIDENCE = rf"^【{_S}*(?:答案|解析|详解|解答|点拨){_S}*】"


def trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r\u3000"))


def number(text: Column) -> Column:
    """Digits of either width."""
    return F.translate(text, "０１２３４５６７８９", "0123456789").cast("int")


def is_value(text: Column) -> Column:
    """Whether what follows a line's number is an answer rather than a question: it begins with a value, a letter or a formula, a sub-question's
    number, or a word of a derivation."""
    body = _after(text, _NO)
    value = body.rlike("^[-−+]?[0-9０-９]")
    symbol = F.left(F.regexp_replace(body, r"^\\", ""), F.lit(1)).rlike("[A-Za-z_$]")
    part = body.rlike(rf"^[(（]{_N}[)）]")
    return text.rlike(_NO) & (value | symbol | part | body.rlike(f"^({'|'.join(_DERIVES)})"))


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _after(text: Column, pattern: str) -> Column:
    return trimmed(F.regexp_replace(text, pattern, ""))


def answer_marks(text: Column) -> Column:
    """``2.D  3. BD  4. 1.5V`` as an array of (no, body), and what stands before the first mark as number null if that is not empty."""
    numbers, bodies = F.regexp_extract_all(text, F.lit(MARK), F.lit(1)), F.transform(F.split(text, MARK), trimmed)
    marked = F.zip_with(numbers, F.slice(bodies, F.lit(2), F.size(bodies)), lambda n, b: F.struct(number(n).alias("no"), b.alias("body")))
    head = F.struct(F.lit(None).cast("int").alias("no"), F.element_at(bodies, 1).alias("body"))
    return F.when((F.size(numbers) > 0) & (F.element_at(bodies, 1) != ""), F.concat(F.array(head), marked)).when(F.size(numbers) > 0, marked).otherwise(F.slice(marked, 1, 0))


def mark_numbers(text: Column) -> Column:
    """The numbers of ``answer_marks``."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(MARK), F.lit(1)), number)
    head = F.array(F.lit(None).cast("int"))
    return F.when((F.size(numbers) > 0) & (trimmed(F.get(F.split(text, MARK, 2), 0)) != ""), F.concat(head, numbers)).otherwise(numbers)


def answer_pairs(text: Column) -> Column:
    """``1AB 2C`` as an array of (no, body)."""
    numbers, letters = (F.regexp_extract_all(text, F.lit(PAIR), F.lit(k)) for k in (1, 2))
    return F.zip_with(numbers, letters, lambda n, b: F.struct(number(n).alias("no"), b.alias("body")))


def _headings() -> dict[str, Column]:
    """A block's title, what stands behind it, and what stands behind an answer's heading."""
    t, head = F.col("t"), _first(F.col("t"), _TITLE)
    return {"head": head, "rest": F.when(head.isNotNull(), _after(t, _TITLE)), "body": F.when(t.rlike(_ANSWER_HEAD), _after(t, _ANSWER_HEAD + rf"{_S}*[:：]?")).otherwise(t)}


def features(blocks: DataFrame, least: int = LEAST_ROWS) -> tuple[DataFrame, bool]:
    """Blocks with all that can be told of each without its past; the columns that begin with ``f_`` are the machine's input; and whether documents are cut into ranges."""
    t = F.col("t")
    b = blocks.select("doc", "idx", F.coalesce("kind", F.lit("p")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("figures", F.array().cast("array<string>")).alias("figures"))
    b = b.where("doc IS NOT NULL").withColumn("t", trimmed(F.col("text")))
    p = F.col("kind") != "table"
    seen = F.struct(
        p.alias("p"), t.rlike(_NO).alias("no"), F.translate(_first(t, _OPTION), "ＡＢＣＤ", "ABCD").alias("option"), t.rlike(_FIRST_PAREN).alias("sub"), (t.rlike(_NO) | t.rlike(_BRACKET_NO)).alias("asks"),
    )
    b, cut = in_ranges(b.withColumn("seen", seen), ["doc"], "idx", least)
    if not cut:
        b = b.repartition("doc")  # all that follows, the machine too, finds a document's blocks in one task
    b = following(b, ["doc"], "idx", p & F.col("seen.option").isNotNull(), 2, "o2", cut=cut)
    b = _told_by_join(b) if cut else _told_in_place(b)
    # What follows skips empty paragraphs; the kind of document is told by the two very next blocks.
    b = following(b.withColumn("__solid", (t != "") | ~p), ["doc", "__solid"], "idx", F.col("seen"), 4, "next", cut=cut)
    b = b.withColumn("next", F.when(F.col("__solid"), F.col("next")))
    upto = F.col("next")  # a table ends what is looked at
    table = F.array_position(F.transform(upto, lambda x: ~x["p"]), True).cast("int")
    upto = F.coalesce(F.when(table > 0, F.slice(upto, F.lit(1), table - 1)).otherwise(upto), F.array().cast(b.schema["next"].dataType))
    b = b.withColumn("next", upto)
    letter = F.get(F.filter(F.transform("next", lambda x: x["option"]), lambda x: x.isNotNull()), 0)
    b, answer_head = b.withColumns(_headings()), t.rlike(_ANSWER_HEAD)
    context = F.create_map(*[F.lit(x) for kv in TITLES.items() for x in kv])
    first = F.get("next", 0)
    found = b.select(
        "doc", "idx", RANGE, "kind", "text", "figures", "t",
        (t == "").alias("f_blank"), (~p).alias("f_table"), (F.size("figures") > 0).alias("f_figures"),
        F.coalesce(F.col("idx") == F.col("forced"), F.lit(False)).alias("f_forced"), F.col("exercise").alias("f_exercise"),
        F.when(t.rlike(rf"^{_N}\.{_N}{_S}*."), 2).when(t.rlike(ABOVE), 1).otherwise(0).alias("f_above"), t.rlike(BOILERPLATE).alias("f_boiler"),
        number(_first(t, _NO)).alias("f_no"), is_value(t).alias("f_value"), t.rlike(_OPTION).alias("f_option"), t.rlike(_PAREN).alias("f_paren"),
        context[F.col("head")].alias("f_head"), (F.col("rest") != "").alias("f_rest"), number(_first(F.col("rest"), _NO)).alias("f_rest_no"), F.col("rest").rlike(_OPTION).alias("f_rest_option"),
        F.when(t.rlike(_TASK), F.when(F.contains(F.regexp_extract(t, _TASK, 0), F.lit("自我测评")), "exercise").otherwise("task")).alias("f_task"), t.rlike(_PIECE).alias("f_piece"),
        F.when(t.rlike(_DIVIDER) & ~t.rlike("^【[^】]*(答案|解析)"), F.when(F.contains(t, F.lit("自我测评")), "exercise").otherwise("same")).alias("f_divider"),
        answer_head.alias("f_answer_head"), (F.col("body") == "").alias("f_bare"), number(_first(t, _ANSWER_NO)).alias("f_answer_no"), t.rlike(_EXPLAIN).alias("f_explain"),
        mark_numbers(F.col("body")).alias("f_marks"), F.transform(answer_pairs(F.col("body")), lambda x: x["no"]).alias("f_pairs"), letter.alias("f_letter"),
        F.coalesce(F.exists(F.slice("next", 1, 2), lambda x: x["sub"]), F.lit(False)).alias("f_sub"),
        F.coalesce(first["asks"], F.lit(False)).alias("f_asks"), F.coalesce(first["option"].isNull() & F.get("next", 1)["option"].isNotNull(), F.lit(False)).alias("f_stem"),
        F.coalesce(first["no"], F.lit(True)).alias("f_numbered"),
    )
    return found, cut


def _evidence() -> tuple[dict[str, Column], Column]:
    """What tells the kind of a document, as aggregates of its blocks, and the blocks from which questions may begin."""
    p, t = F.col("seen.p"), F.col("t")
    evidence, titled = p & t.rlike(_EVIDENCE), p & t.rlike(_TITLE + "$")
    asks = p & F.col("seen.no") & F.exists("o2", lambda x: x)
    told = {
        "titled": F.bool_or(titled), "evidence": F.count_if(evidence), "asks": F.count_if(asks),
        "answers": F.min(F.when(evidence, F.col("idx"))), "headed": F.min(F.when(p & F.startswith(t, F.lit("课后练习")), F.col("idx"))),
    }
    return told, p & F.col("seen.no") & (F.col("idx") < F.col("answers")) & (F.col("headed").isNull() | (F.col("headed") >= F.col("answers")))


def _exercise() -> Column:
    return ~F.col("titled") & ((F.col("evidence") >= 3) | (F.col("asks") >= 3))


def _told_in_place(b: DataFrame) -> DataFrame:
    """Blocks with ``exercise``, whether their document is questions from its beginning, and ``forced``, the block from which it is."""
    told, before = _evidence()
    by_doc = Window.partitionBy("doc")
    b = b.withColumns({k: v.over(by_doc) for k, v in told.items()})
    return b.withColumns({"exercise": _exercise(), "forced": F.max(F.when(before, F.col("idx"))).over(by_doc)}).drop(*told)


def _told_by_join(b: DataFrame) -> DataFrame:
    """The same for documents that are cut into ranges."""
    aggregates, before = _evidence()
    told = b.groupBy("doc").agg(*[v.alias(k) for k, v in aggregates.items()])
    forced = b.join(told.where("answers IS NOT NULL").select("doc", "answers", "headed"), "doc").where(before).groupBy("doc").agg(F.max("idx").alias("forced"))
    return b.join(told.select("doc", _exercise().alias("exercise")).join(forced, "doc", "left"), "doc", "left")


#: What is carried from block to block: context, whether answers are read, the number whose answer is open, the open question, whether the
#: document's head is behind, the last number in this group, the group's answered numbers, whether there is any question, whether the block before
#: belonged to a question, whether an exercise title stands last, the block whose figures wait for a question, whether the next stem needs no number.
START: dict[str, Any] = {"context": "list", "reading": False, "open": None, "question": None, "begun": False, "last": 0, "answered": [], "any": False, "near": False, "titled": False, "waiting": None, "forced": False}


def decide(s: dict[str, Any], f: dict[str, Any]) -> tuple[str, int | None, list[tuple[str, int | None]]]:
    """(act, number, opened sections): what the block with features ``f`` is in state ``s``, which moves on."""
    near, s["near"] = s["near"], False
    if f["f_forced"]:
        s["context"] = "exercise"
        _new_group(s)
    if f["f_table"]:
        return "table", None, []
    if f["f_blank"]:
        return ("question_figure" if s["any"] and s["context"] == "exercise" else "figure") if f["f_figures"] else "nothing", None, []
    if not s["begun"]:
        if f["f_above"]:
            return ("lesson" if f["f_above"] == 2 else "nothing"), None, []
        s["begun"] = True
    if f["f_boiler"]:
        return "nothing", None, []
    no, marks = f["f_no"], f["f_marks"]
    asks = no is not None and (no in s["answered"] or f["f_letter"] == "A" or f["f_sub"])
    if s["reading"] and asks and not f["f_value"]:
        s["reading"], s["open"] = False, None
        s["context"] = "exercise" if s["context"] == "answer" else s["context"]
    if f["f_head"] and not f["f_answer_head"]:
        return _title(s, f)
    if f["f_task"] or f["f_piece"]:
        s |= {"question": None, "reading": False, "open": None, "titled": False}
        s["context"] = f["f_task"] or s["context"]
        return ("task" if f["f_task"] else "piece"), None, [("task", None)]
    if found := _answer(s, f, marks):
        return *found, []
    if f["f_divider"]:
        s["question"], s["titled"] = None, False
        s["context"] = "exercise" if f["f_divider"] == "exercise" else s["context"]
        return "divider", None, [("task", None)]
    if s["context"] == "exercise" and (no is not None or s["forced"]):
        number = no if no is not None else s["last"] + 1
        return "stem", number, [_question(s, number)]
    if f["f_option"] and s["question"] is not None:
        s["near"] = True
        return "option", s["question"], []
    if s["context"] == "exercise" and (near or s["titled"]) and not f["f_option"] and not f["f_paren"] and f["f_letter"] == "A":
        number = s["last"] + 1
        return "stem", number, [_question(s, number)]
    return "text", None, []


def _new_group(s: dict[str, Any]) -> None:
    s["last"], s["answered"] = 0, []


def _question(s: dict[str, Any], number: int, near: bool = True) -> tuple[str, int]:
    s |= {"question": number, "last": number, "any": True, "near": near, "titled": False, "waiting": None, "forced": False, "reading": False, "open": None}
    return "q", number


def _title(s: dict[str, Any], f: dict[str, Any]) -> tuple[str, int | None, list[tuple[str, int | None]]]:
    context = f["f_head"]
    s["question"], s["titled"] = None, context == "exercise"
    s["context"], s["reading"], s["open"] = context, context == "answer", None
    if context != "exercise":
        return "title", None, [("h", None)]
    _new_group(s)
    if f["f_figures"] and (f["f_asks"] or f["f_stem"]):
        s["waiting"] = f["idx"] if s["waiting"] is None else s["waiting"]
        s["forced"] = not f["f_numbered"]
    number, waits = f["f_rest_no"], s["waiting"] is not None
    if f["f_rest"] and (number is not None or f["f_letter"] is not None or (waits and f["f_rest_option"])):
        own = number if number is not None else s["last"] + 1
        forced = s["forced"]
        opened = [("h", None), _question(s, own, near=number is not None)]
        s["forced"] = forced
        return "title_stem", own, opened
    return "title", None, [("h", None)]


def _answer(s: dict[str, Any], f: dict[str, Any], marks: list[int | None]) -> tuple[str, int | None] | None:
    """(act, number) where the block is read as answers."""

    def listed(act: str, numbers: list[int | None], open_: int | None) -> tuple[str, None]:
        s["answered"] = sorted({*s["answered"], *(1 if n is None else n for n in numbers)})
        s["open"], s["reading"] = open_, True
        return act, None

    def single(act: str, number: int) -> tuple[str, int]:
        s["answered"] = sorted({*s["answered"], number})
        s["open"], s["reading"] = number, True
        return act, number

    whole = bool(marks) and marks[0] is not None
    if s["context"] == "answer":
        s["reading"] = True
        if marks and not f["f_answer_head"]:
            return listed("answers", marks, marks[-1])
    if f["f_answer_head"]:
        if f["f_bare"] or whole or len(f["f_pairs"]) >= 2 or s["question"] is not None:
            s["context"] = "answer"
            if f["f_bare"]:
                s["open"], s["reading"] = None, True
                return "answer_head", None
            if whole:
                return listed("answers", marks, marks[-1])
            if len(f["f_pairs"]) >= 2:
                return listed("pairs", f["f_pairs"], None)
            return single("answer", s["question"])
    if f["f_answer_no"] is not None:
        return single("numbered_answer", f["f_answer_no"])
    if s["reading"]:
        if whole:
            return listed("answers", marks, marks[-1])
        if s["open"] is not None:
            return single("explanation" if f["f_explain"] else "more", s["open"])
    return None


_OUT = {"act": pa.string(), "number": pa.int32(), "opened": pa.int32(), "questions": pa.int32(), "groups": pa.int32(), "waits": pa.int64(), "state": pa.string()}


def _run(rows: DataFrame, carried: Sequence[str] = (), placed: bool = False) -> DataFrame:
    """Decisions (doc, __range, idx, act, number, opened, questions, groups, waits, state) for rows with features and
    ``__in``, the state that a range begins with, or null for a guess; ``state`` is set on a range's last row. Columns that are ``carried`` pass by the machine;
    rows that are ``placed`` have each document in one task already."""
    schema = rows.select("doc", RANGE, "idx", *carried).schema
    inputs = sorted(c for c in rows.columns if c.startswith("f_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, held = None, dict(START), None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {n: batch.column(n).to_pylist() for n in ("doc", RANGE, "idx", "__in", *inputs)}
            out: list[tuple] = []
            ends: list[str | None] = []  # of the row before each
            for i, key in enumerate(zip(columns["doc"], columns[RANGE], strict=True)):
                f = {c: columns[c][i] for c in inputs} | {"idx": columns["idx"][i]}
                ends.append(json.dumps(state) if key != now and now is not None else None)
                if key != now:
                    given = columns["__in"][i]
                    now, state = key, json.loads(given) if given else START | {"answered": [], "context": "exercise" if f["f_exercise"] else "list", "begun": key[1] > 0}
                out.append(decided_row(state, f))
            # A batch goes on its way when the next one tells whether its last range goes on.
            if held is not None:
                yield pack(*held, ends[0])
            held = batch, out, ends[1:]
        if held is not None:
            yield pack(*held, json.dumps(state))

    def decided_row(state: dict[str, Any], f: dict[str, Any]) -> tuple:
        """(act, number, opened, questions, groups, waits): ``waits`` names the first of the titles whose figures wait for one question, at these and at the question."""
        held = state["waiting"]
        act, number, opened = decide(state, f)
        titled = act in ("title", "title_stem") and f["f_head"] == "exercise"
        questions = sum(k == "q" for k, _ in opened)
        joins = titled and f["f_figures"] and (f["f_asks"] or f["f_stem"])
        waits = (held if held is not None else f["idx"] if joins else None) if joins or questions else None
        return act, number, len(opened), questions, int(f["f_forced"]) + int(titled), waits

    def pack(batch: pa.RecordBatch, out: list[tuple], ends: list[str | None], end: str | None) -> pa.RecordBatch:
        found = [*zip(*out, strict=True), [*ends, end]]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), *(pa.array(c, t) for c, t in zip(found, _OUT.values(), strict=True))], names=[*passed, *_OUT])

    passed = schema.names
    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in schema) + ", act string, number int, opened int, questions int, groups int, waits long, state string"
    used = rows.select(*passed, "__in", *inputs)
    dealt = used if placed else used.repartition("doc", RANGE)
    return dealt.sortWithinPartitions("doc", RANGE, "idx").mapInArrow(run, schema)


def decisions(blocks: DataFrame, least: int = LEAST_ROWS, texts: bool = True) -> DataFrame:
    """Blocks with their act, number, group, and the sections (``sid``, from 1) that they open and stand in; without ``texts``, nothing but that and the decisions' own columns."""
    ranged, cut = features(blocks, least)
    own = ["kind", "text", "figures", "t"] if texts else []
    ranged = ranged.withColumn("__in", F.lit(None).cast("string"))
    if cut:
        ranged = durable(ranged)
        decided = _settled(ranged.drop("__in"), _run(ranged))
        rows = ranged.select("doc", RANGE, "idx", *own).join(decided.drop("state"), ["doc", RANGE, "idx"]) if texts else decided.drop("state")
    else:
        rows = _run(ranged, own, placed=True).drop("state")
    rows = prefix_scan(rows, ["doc"], "idx", sums={"sid": F.col("opened"), "grp": F.col("groups")}, cut=cut)
    rows = prefix_scan(rows, ["doc"], "idx", lasts={"qid": F.when(F.col("questions") > 0, F.col("sid"))}, cut=cut).drop("groups", RANGE)
    return rows.withColumns(_headings()) if texts else rows


def _settled(ranged: DataFrame, decided: DataFrame) -> DataFrame:
    """Run ranges again until each began with the state that the one before it ended with."""
    decided = durable(decided)
    by_doc = Window.partitionBy("doc").orderBy(RANGE)
    used = None
    while True:
        ends = decided.where("state IS NOT NULL").select("doc", RANGE, F.lag("state").over(by_doc).alias("__in")).where(F.col(RANGE) > 0)
        changed = ends if used is None else ends.join(used.withColumnRenamed("__in", "__was"), ["doc", RANGE]).where(~F.col("__in").eqNullSafe(F.col("__was"))).drop("__was")
        changed = durable(changed)  # a row for each range
        if changed.isEmpty():
            return decided
        again = _run(ranged.join(F.broadcast(changed), ["doc", RANGE]))
        before, decided = decided, durable(decided.join(F.broadcast(changed), ["doc", RANGE], "left_anti").unionByName(again))
        used = changed if used is None else durable(used.join(F.broadcast(changed), ["doc", RANGE], "left_anti").unionByName(changed))
        forget(before)


#: Acts whose text belongs to a section, and whose figures do.
_IN_SECTION = ["table", "text", "title", "title_stem", "task", "piece", "stem", "option"]
_ANSWERS = ["answer", "numbered_answer", "explanation", "more"]


def _body(t: Column) -> Column:
    act, rest = F.col("act"), F.col("rest")
    return (
        F.when(act.isin("title", "title_stem") & (rest == ""), None)
        .when(act == "title", F.when(F.col("head") != "课后练习答案", rest))
        .when(act == "title_stem", _after(rest, _NO))
        .when(act == "task", F.nullif(_after(t, _TASK), F.lit("")))
        .when(act == "piece", F.nullif(_after(t, _PIECE), F.lit("")))
        .when(act == "stem", _after(t, _NO))
        .when(act == "answer", F.col("body"))
        .when(act == "numbered_answer", _after(t, _ANSWER_NO))
        .when(act == "explanation", _after(t, _EXPLAIN))
        .otherwise(t)
    )


def sections(decided: DataFrame) -> DataFrame:
    """(doc, sid, kind, title, no, grp) of every section; 0 is what stands before the first."""
    t, act = F.col("t"), F.col("act")
    title = F.when(act.isin("title", "title_stem"), F.col("head")).when(act == "task", F.regexp_extract(t, _TASK, 0)).when(act == "piece", F.regexp_extract(t, _PIECE, 0)).when(act == "divider", t)
    opened = decided.where("opened > 0").select("doc", "sid", "act", "number", "grp", "opened", title.alias("title"))
    own = opened.where("act <> 'title'").select(
        "doc", "sid", F.when(F.col("number").isNotNull(), "q").otherwise("task").alias("kind"), F.when(F.col("number").isNull(), F.col("title")).alias("title"), F.col("number").alias("no"), F.when(F.col("number").isNotNull(), F.col("grp")).alias("grp"),
    )
    heads = opened.where(act.isin("title", "title_stem")).select("doc", (F.col("sid") - F.col("opened") + 1).alias("sid"), F.lit("h").alias("kind"), "title", F.lit(None).cast("int").alias("no"), F.lit(None).cast("long").alias("grp"))
    # Of the items of a section, one stays at least.
    some = _texts(decided).select("doc", "sid").unionByName(_figures(decided).select("doc", "sid"))
    first = some.where("sid = 0").distinct().select("doc", "sid", F.lit("h").alias("kind"), F.lit("正文").alias("title"), F.lit(None).cast("int").alias("no"), F.lit(None).cast("long").alias("grp"))
    return own.unionByName(heads).unionByName(first)


def _target() -> Column:
    return F.when(F.col("act").isin("option", "question_figure"), F.col("qid")).otherwise(F.col("sid"))


def _texts(decided: DataFrame) -> DataFrame:
    act = F.col("act")
    found = decided.where(act.isin(_IN_SECTION)).select("doc", _target().alias("sid"), "idx", F.lit(0).alias("pos"), F.when(act == "table", "table").otherwise("p").alias("kind"), _body(F.col("t")).alias("value"))
    return found.where("value IS NOT NULL")


def _figures(decided: DataFrame) -> DataFrame:
    """Figures of blocks that are nothing else."""
    act = F.col("act")
    return decided.where(act.isin("figure", "question_figure")).select("doc", _target().alias("sid"), "idx", F.posexplode("figures").alias("pos", "value"), (act == "question_figure").alias("own"))


def paragraphs(decided: DataFrame) -> DataFrame:
    """The ``items`` that are no figures."""
    return _texts(decided)


def items(decided: DataFrame) -> DataFrame:
    """(doc, sid, idx, pos, kind, value): paragraphs ``p``, tables and figures ``fig`` of each section, in order.

    Figures of an exercise go to the question before them; those beside an exercise title to the question after it, before its text. A figure that a section's text shows
    inline, or that it has already, is left out of questions and tasks.
    """
    act, texts, figures = F.col("act"), _texts(decided).withColumn("own", F.lit(False)), _figures(decided)
    waiting = decided.where("waits IS NOT NULL")
    takers = waiting.where("questions > 0").select("doc", "waits", F.col("sid").alias("to"))
    late = waiting.where(act.isin("title", "title_stem") & (F.size("figures") > 0)).select("doc", "waits", F.posexplode("figures").alias("pos", "value"), "idx").join(takers, ["doc", "waits"])
    late = late.select("doc", F.col("to").alias("sid"), "idx", (F.col("pos") - 1_000_000).alias("pos"), "value", F.lit(True).alias("own"))
    every = texts.unionByName(figures.unionByName(late).withColumn("kind", F.lit("fig")))
    inline = texts.where(F.contains("value", F.lit('src="media/'))).select("doc", "sid", F.explode(F.regexp_extract_all("value", F.lit('src="media/(?:[^"]*/)?([^"/]+)"'), F.lit(1))).alias("name")).distinct()
    kinds = decided.where("opened > 0 AND act IN ('stem', 'title_stem', 'task', 'piece', 'divider')").select("doc", "sid", F.lit(True).alias("__unique"))
    name = F.element_at(F.split("value", "/"), -1)
    marked = every.join(kinds, ["doc", "sid"], "left").withColumn("name", F.when((F.col("kind") == "fig") & F.col("__unique"), name))
    once = Window.partitionBy("doc", "sid", F.coalesce("name", F.concat_ws(":", "idx", "pos"))).orderBy("idx", "pos")
    kept = marked.withColumn("__k", F.row_number().over(once)).where("name IS NULL OR __k = 1").join(inline, ["doc", "sid", "name"], "left_anti")
    return kept.select("doc", "sid", "idx", "pos", "kind", "value")


def answers(decided: DataFrame) -> DataFrame:
    """(doc, grp, no, idx, pos, tag, text): every piece of an answer; a list's first piece without a number is for number 1."""
    act, body = F.col("act"), F.col("body")
    one = decided.where(act.isin(_ANSWERS)).select("doc", "grp", F.col("number").alias("no"), "idx", F.lit(0).alias("pos"), F.when(act.isin("explanation", "more"), "解析").otherwise("答案").alias("tag"), _body(F.col("t")).alias("text"))
    lists = decided.where(act.isin("answers", "pairs")).select("doc", "grp", "idx", F.posexplode(F.when(act == "pairs", answer_pairs(body)).otherwise(answer_marks(body))).alias("pos", "x"))
    return one.unionByName(lists.select("doc", "grp", F.coalesce("x.no", F.lit(1)).alias("no"), "idx", "pos", F.lit("答案").alias("tag"), F.col("x.body").alias("text")))


def answer_sections(found: DataFrame) -> DataFrame:
    """(doc, grp, no, place, tag, title, parts): a section for each answered number, placed by group and number."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "pos", "text"))), lambda x: x["text"]), "\n")
    by_number = found.groupBy("doc", "grp", "no").agg(F.when(F.bool_or(F.col("tag") == "解析"), "解析").otherwise("答案").alias("tag"), F.count(F.lit(1)).alias("parts"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("doc").orderBy("grp", "no"))
    return by_number.select("doc", "grp", "no", place.cast("long").alias("place"), "tag", F.concat(F.col("no").cast("string"), F.lit("．"), "tag").alias("title"), "parts", "text")
