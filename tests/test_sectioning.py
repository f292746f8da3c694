"""The sectionizer's cases, and documents cut into ranges."""

import random

import pytest
from pyspark.sql import functions as F

from lessonweave.operators import sectioning as S
from lessonweave.plans.section_queries import SHAPES

SCHEMA = "doc string, idx int, kind string, text string, figures array<string>"


def frame(spark, docs):
    rows = []
    for doc, blocks in docs.items():
        for i, b in enumerate(blocks):
            rows.append((doc, i, *(b if isinstance(b, tuple) else ("p", b, []))))
    return spark.createDataFrame(rows, SCHEMA)


CASES = {
    "C21": ["课后练习", "1．题", "A．x", "【课后练习答案】", "1．18.4  2．0.900"],
    "C22": ["【学习任务四】拓展学习"],
    "C23": ["课后练习", "1．题", "2．题", "答案1A 2B", "自我测评", "1．题", "2．题", "答案1C 2D"],
    "C24": ["课后练习", "题干没有号", "A．a", "B．b", "C．c", "D．d", "2．题"],
    "C15": ["课后练习", "1．题", "答案：2.D  3. BD  4. 1.5V 5．7"],
    "C16": ["课后练习答案", "AD   2．B  3．AB"],
    "forced": ["讲义", "1．如图", "2．如图", "【答案】", "B"],
    "exercise": ["1．如图", "A．a", "2．如图", "A．a", "3．如图", "A．a", "(1)小问", "正文"],
    "table": ["课后练习", "1．如图", ("table", "表", [])],
    "figures": ["课后练习", "1．如图", ("p", "", ["media/a.png", "media/b.png", "media/a.png"]), "【课堂探究】第一部分", ("p", None, ["media/c.png"])],
    "inline": ["课后练习", '1．如图<img src="media/a.png">', ("p", "", ["media/a.png", "media/b.png"])],
    "waiting": [("p", "自我测评", ["media/w.png"]), "漏了题号的题干", "A．a"],
    "before": ["必修三", "11.2 电阻", "正文", "必修三"],
    "continued": ["课后练习", "1．如图", "答案：A", "因为", "解析：略", "学习目标", "1.掌握"],
    "empty": ["", None],
    "piece": ["《二》【学习目标】内容", "【判断正误】"],
}


@pytest.fixture(scope="module")
def decided(spark):
    return S.decisions(frame(spark, CASES)).cache()


def acts(decided, doc):
    return [r.act for r in decided.where(F.col("doc") == doc).orderBy("idx").collect()]


def answers(decided, doc):
    return {(r.grp, r.no): (r.tag, r.text) for r in S.answer_sections(S.answers(decided.where(F.col("doc") == doc))).collect()}


def sections(decided, doc):
    return [(r.kind, r.title, r.no, r.grp) for r in S.sections(decided.where(F.col("doc") == doc)).orderBy("sid").collect()]


def items(decided, doc):
    return [(r.sid, r.kind, r.value) for r in S.items(decided.where(F.col("doc") == doc)).orderBy("sid", "idx", "pos").collect()]


def test_cases(decided):
    assert sections(decided, "C21") == [("h", "课后练习", None, None), ("q", None, 1, 1)]
    assert answers(decided, "C21") == {(1, 1): ("答案", "18.4"), (1, 2): ("答案", "0.900")}
    assert sections(decided, "C22") == [("task", "【学习任务四】", None, None)] and items(decided, "C22") == [(1, "p", "拓展学习")]
    assert set(answers(decided, "C23")) == {(1, 1), (1, 2), (2, 1), (2, 2)}
    assert [s[2] for s in sections(decided, "C24") if s[0] == "q"] == [1, 2]
    assert answers(decided, "C15") == {(1, 2): ("答案", "D"), (1, 3): ("答案", "BD"), (1, 4): ("答案", "1.5V"), (1, 5): ("答案", "7")}
    assert answers(decided, "C16") == {(0, 1): ("答案", "AD"), (0, 2): ("答案", "B"), (0, 3): ("答案", "AB")}


def test_kind_of_document(decided):
    assert acts(decided, "forced") == ["text", "text", "stem", "answer_head", "text"]
    assert acts(decided, "exercise") == ["stem", "option", "stem", "option", "stem", "option", "text", "text"]


def test_figures_and_tables(decided):
    assert items(decided, "table") == [(2, "p", "如图"), (2, "table", "表")]
    assert items(decided, "figures") == [(2, "p", "如图"), (2, "fig", "media/a.png"), (2, "fig", "media/b.png"), (3, "p", "第一部分"), (3, "fig", "media/c.png")]
    assert [i for i in items(decided, "inline") if i[1] == "fig"] == [(2, "fig", "media/b.png")]
    assert items(decided, "waiting") == [(2, "fig", "media/w.png"), (2, "p", "漏了题号的题干"), (2, "p", "A．a")]


def test_heads_answers_and_empty_texts(decided):
    assert acts(decided, "before") == ["nothing", "lesson", "text", "text"]
    assert sections(decided, "before") == [("h", "正文", None, None)]
    assert acts(decided, "continued") == ["title", "stem", "answer", "more", "explanation", "title", "text"]
    assert answers(decided, "continued") == {(1, 1): ("解析", "A\n因为\n略")}
    assert acts(decided, "empty") == ["nothing", "nothing"]
    assert [s[1] for s in sections(decided, "piece")] == ["《二》【学习目标】", "【判断正误】"]


def test_no_documents(spark):
    none = S.decisions(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and S.sections(none).count() == 0 and S.answer_sections(S.answers(none)).count() == 0


def test_large_documents_in_ranges(spark):
    """One document holds most blocks; its ranges begin with guesses and end with the decisions of a single pass."""
    rng = random.Random(3)
    docs = {"large": [rng.choice(SHAPES).replace("*", "abc" * rng.randrange(3)) for _ in range(700)], "small": ["课后练习", "1．如图"], "calm": ["文"] * 30}
    blocks = frame(spark, docs)
    whole, cut = (sorted(map(str, S.decisions(blocks, least).select("doc", "idx", "act", "number", "sid", "grp", "qid", "waits").collect())) for least in (10_000, 40))
    assert whole == cut


def test_editions(spark):
    """Room only after questions without options; answers after each question; answers alone with a notice for tasks."""
    from lessonweave.operators.editions import OPEN_TASK, edition

    docs = {"d": ["课后练习", "1．如图", "A．甲", "2．计算", "【学习任务一】读书", "课后练习答案", "1．A  2．因为 ", "解析：略"], "plain": ["自我测评", "1．如图", "2．如图", "答案：B"]}
    decided = S.decisions(frame(spark, docs))
    lines = lambda mode: [(r.doc, r.part, r.place, r.sub, r.line) for r in edition(decided, mode).orderBy("doc", "part", "place", "sub").collect()]
    student = [r for r in lines("student") if r[0] == "d"]
    assert student == [("d", 0, 1, 0, "课后练习"), ("d", 0, 2, 0, "1．"), ("d", 0, 2, 1, "如图\nA．甲"), ("d", 0, 3, 0, "2．"), ("d", 0, 3, 1, "计算"), ("d", 0, 3, 2, "___"), ("d", 0, 4, 0, "【学习任务一】"), ("d", 0, 4, 1, "读书"), ("d", 0, 5, 0, "课后练习答案")]
    assert [r[4] for r in lines("teacher") if r[3] == 2] == ["【答案】A", "【解析】因为\n略", "【答案】B"]
    assert lines("answer") == [("d", 0, 4, 1, OPEN_TASK), ("d", 1, 1, 0, "1．答案　A"), ("d", 1, 2, 0, "2．解析　因为\n略"), ("plain", 1, 1, 0, "2．答案　B")]
    with pytest.raises(ValueError):
        edition(decided, "other")


def test_blocks_are_dealt_once_for_the_machine(spark):
    decided = S.decisions(frame(spark, CASES))
    plan = decided._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_white_space_is_trimmed_as_sql_does(spark):
    rows = spark.createDataFrame([(" 　a b　\t\n",), ("a  ",), ("　 ",), (None,)], "t string")
    assert [r[0] for r in rows.select(S.trimmed(F.col("t"))).collect()] == ["a b", "a  ", "", ""]
