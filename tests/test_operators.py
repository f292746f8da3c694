"""Cases that the tables do not hold, and folds against plain Python."""

import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from lessonweave.functions import mathx, text
from lessonweave.operators import answers, blocks, catalog, sections
from lessonweave.sources import catalog as sources
from lessonweave.sources.docx import read_docx
from lessonweave.streaming.resume import run_new_files


def test_pick_has_no_second_choice(spark):
    items = spark.createDataFrame(
        [(1, 0, "pdf", "pdf", ["cs://x"]), (1, 1, "other", "doc", ["http://h/x.doc"]), (2, 0, "folder", "", ["http://h/f"]), (2, 1, "file", "", ["http://h/a.b?q=1.x"]), (3, 0, "ai_x", "", ["http://h/y"])],
        "bundle int, pos int, flag string, format string, storages array<string>",
    )
    got = {r["bundle"]: (r["flag"], r["url"], r["ext"]) for r in catalog.pick_resource(items, "bundle", "pos").collect()}
    assert got == {1: ("pdf", None, "pdf"), 2: ("file", "http://h/a.b?q=1.x", "b")}


def test_pending_head_and_no_number(spark):
    rows = spark.createDataFrame([(1, 0, None), (1, 1, 7), (1, 2, None), (2, 0, None)], "doc int, idx int, no int")
    got = [(r["doc"], r["idx"], r["owner"]) for r in answers.attach_to_number(rows, "doc", "idx", "no").orderBy("doc", "idx").collect()]
    assert got == [(1, 0, 7), (1, 1, 7), (1, 2, 7), (2, 0, None)]


def test_double_lookup_keeps_groups_apart(spark):
    q = spark.createDataFrame([(1, 3, 1), (1, 3, 2), (1, 4, 2), (1, 5, 0)], "doc int, no int, grp int")
    a = spark.createDataFrame([(1, 3, 1, "one"), (1, 3, 2, " "), (1, 3, 0, "plain"), (1, 4, 1, "x")], "doc int, no int, grp int, body string")
    got = {(r["no"], r["grp"]): r["body"] for r in answers.double_lookup(q, a).collect()}
    assert got == {(3, 1): "one", (3, 2): "plain", (4, 2): None, (5, 0): None}


def test_numbers_are_repaired_in_their_part(spark):
    rows = spark.createDataFrame([(1, i, n) for i, n in enumerate([None, None, 5, None, 9])] + [(2, 0, None)], "doc int, idx int, n int")
    got = [r["no"] for r in blocks.repair_numbers(rows, ["doc"], ["idx"], "n").orderBy("doc", "idx").collect()]
    assert got == [1, 2, 5, 6, 9, 1]


def merged(rects):
    out = []
    for y0, x0, y1, x1 in sorted(rects):
        if out and y0 - out[-1][2] <= 6 and x0 - out[-1][3] <= 40 and out[-1][1] - x1 <= 40:
            a = out[-1]
            out[-1] = (min(a[0], y0), min(a[1], x0), max(a[2], y1), max(a[3], x1))
        else:
            out.append((y0, x0, y1, x1))
    return out


def test_rectangles_merge_like_a_fold(spark):
    rng = random.Random(5)
    pages = {p: [(y := rng.randint(0, 300) * 1.0, x := rng.randint(0, 300) * 1.0, y + rng.randint(1, 30), x + rng.randint(1, 60)) for _ in range(rng.randint(1, 25))] for p in range(20)}
    df = spark.createDataFrame([(p, *map(float, r)) for p, rs in pages.items() for r in rs], "page int, y0 double, x0 double, y1 double, x1 double")
    got = {}
    for r in blocks.merge_rects(df, "page").orderBy("page", "n").collect():
        got.setdefault(r["page"], []).append((r["y0"], r["x0"], r["y1"], r["x1"]))
    assert got == {p: merged(rs) for p, rs in pages.items()}


def test_sections_follow_state(spark):
    texts = ["前言", "学习目标", "正文", "【学习任务四】拓展", "课后练习", "1．题目", "A．甲", "【答案】B", "2. 1.5V 的题", "课后练习答案", "1．18.4", "10.045"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)] + [(2, 0, None)], "doc int, idx int, text string")
    got = [(r["kind"], r["no"]) for r in sections.sectionize(df).where("doc = 1").orderBy("idx").collect()]
    assert got == [("pre", None), ("h", None), ("h", None), ("task", None), ("h", None), ("q", 1), ("q", 1), ("ans", 1), ("q", 2), ("h", None), ("ans", 1), ("ans", 1)]
    assert sections.sectionize(df).where("doc = 2").first()["kind"] == "pre"


def test_no_section_is_cut_if_it_fits(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(d, i, rng.randint(10, 200)) for d in range(3) for i in range(6)], "doc int, idx int, h long")
    rows = sections.paginate(df, "doc", "idx", "h", 400).orderBy("doc", "idx").collect()
    for d in range(3):
        used = {}
        for r in (r for r in rows if r["doc"] == d):
            used[r["page"]] = used.get(r["page"], 0) + r["h"]
        assert all(v <= 400 for v in used.values()) and list(used) == sorted(used)


def test_all_cuts_of_a_long_document_are_settled(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(d, i, rng.choice([24, 42, 60, 186, 390, 900])) for d in range(2) for i in range(500)], "doc int, idx int, h long")
    rows = sections.paginate(df, "doc", "idx", "h", 740).orderBy("doc", "idx").collect()
    for d in range(2):
        page, left = 0, 740
        for r in (r for r in rows if r["doc"] == d):
            while left <= 0:
                page, left = page + 1, left + 740
            if left < r["h"] <= 740:
                page, left = page + 1, 740
            assert r["page"] == page
            left -= r["h"]
        assert page > 50


@pytest.mark.parametrize(
    "tex, want",
    [
        (r"\frac{a+b}{2}", "(a+b)/2"),
        ("4{ \\rm{ m } }{ \\rm{ m } } ^ { 2 }", "4mm<sup>2</sup>"),
        (r"\sqrt[3]{x} < \alpha", "<sup>3</sup>√(x)&lt;α"),
        ("x^23", "x<sup>2</sup>3"),
        ("", ""),
        ("{a", "a"),
        ("a}b", "ab"),
        (None, None),
    ],
)
def test_latex(tex, want):
    assert mathx.latex_to_html(tex) == want


def test_options_and_offsets():
    assert mathx.split_options("四个点$ A. $、0.85ΩA．甲 B．乙") == ("四个点$ A. $、0.85Ω", ["A．甲", "B．乙"])
    assert mathx.split_options("xA.1 B.2") == ("xA.1 B.2", [])
    assert mathx.plain_map("a<b>&amp;c</b>") == ("a&c", [0, 4, 9])
    assert mathx.omml_to_latex("<broken") is None


def test_text_functions(spark):
    row = spark.range(1).select(
        text.sanitize(F.lit('a\t/:b  c?')).alias("a"),
        text.sanitize(F.lit(None).cast("string")).alias("b"),
        text.field_to_latex(F.lit(r"\f(U,L)")).alias("c"),
        text.timestamp_srt(F.lit(59.9996)).alias("d"),
        text.fold_math(F.lit("\U0001d463\U0001d7cf")).alias("e"),
        text.map_symbols(F.lit(""), F.lit("SymbolMT")).alias("f"),
    ).first()
    assert tuple(row) == ("a_b c_", "unnamed", r"\frac{U}{L}", "00:01:00,000", "v1", "→")


def test_catalog_and_courses(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"chapter": "1", "book": "b", "lessons": [{"lesson_no": "5", "lesson": "x", "resources": [{"type": "v", "url": "u"}]}, {"lesson_no": "5", "lesson": "y", "resources": []}]}))
    rows = sources.catalog_resources(sources.read_json(spark, str(tmp_path / "c.json"), sources.CATALOG).drop("file")).collect()
    assert [(r["lesson_pos"], r["type"], r["period"]) for r in rows] == [(0, "v", None)]
    out = str(tmp_path / "out")
    sources.write_sections(spark.createDataFrame([("a", 1)], "lesson_id string, sid int"), out)
    assert spark.read.json(out).first()["lesson_id"] == "a"
    assert sources.listing(spark, str(tmp_path), "*.json").where("name = 'c.json'").count() == 1


def test_docx(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = lambda t, x="": f"<w:p><w:r>{x}<w:t>{t}</w:t></w:r></w:p>"
    sup = '<w:rPr><w:vertAlign w:val="superscript"/></w:rPr>'
    cell = lambda t: f"<w:tc>{p(t)}</w:tc>"
    body = p("m") + p("2", sup) + f"<w:tbl><w:tr>{cell('one')}</w:tr></w:tbl><w:tbl><w:tr>{cell('a')}{cell('b')}</w:tr></w:tbl>"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
    (tmp_path / "a.docx").write_bytes(data.getvalue())
    (tmp_path / "b.docx").write_bytes(b"nothing")
    rows = read_docx(spark, str(tmp_path)).orderBy("path", "idx").collect()
    assert [(r["kind"], r["text"], r["cells"]) for r in rows[:4]] == [("p", "m", None), ("p", "<sup>2</sup>", None), ("p", "one", None), ("table", None, [["a", "b"]])]
    assert rows[4]["kind"] == "error"


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    for k in (1, 2):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"a": k}))
        run_new_files(spark, source, "a int", lambda df: df.withColumn("b", F.col("a") * 10), target, checkpoint)
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(1, 10), (2, 20)]


def test_bands_need_no_join(spark):
    f = spark.createDataFrame([(1, 0.0, 10.0)], "page int, y0 double, y1 double")
    b = spark.createDataFrame([(1, 5.0, 7.0)], "page int, lo double, hi double")
    plan = blocks.outside_bands(f, b, ["page"])._jdf.queryExecution().toString()
    assert "Join" not in plan and "Window" in plan


def test_offsets_are_packed_page_by_page():
    import pandas as pd

    found = mathx.html_offsets.func(pd.Series(["<p>a&amp;b</p>", None, ""]))
    assert found["at"][0].dtype.itemsize == 4 and list(found["at"][0]) == [3, 4, 9] and found["plain"][0] == "a&b"
    assert found["at"][1] is None and found["plain"][2] == "" and len(found["at"][2]) == 0
