"""Pages, geometry, nesting, pagination, closures and prefixes against literal cases and brute force."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lessonweave.operators import blocks, catalog, catalog_build, elements, lines, markup, pages, pagination
from lessonweave.checkpoints import shared_path

BOX = "x0 double, y0 double, x1 double, y1 double"


def test_floating_fragments_go(spark):
    """A formula at the height of prose stays, one beside it and one at no prose's height go."""
    rows = [(1, 0, 0, "正文", 0.0, 0.0, 100.0, 10.0), (1, 0, 1, "x=1", 50.0, 2.0, 60.0, 8.0), (1, 0, 2, "y=2", 120.0, 2.0, 130.0, 8.0), (1, 0, 3, "z=3", 10.0, 80.0, 20.0, 90.0), (1, 1, 4, "only=1", 0.0, 0.0, 9.0, 9.0), (1, 2, 5, "très long ☃", 0.0, 0.0, 9.0, 9.0)]
    kept = pages.without_fragments(spark.createDataFrame(rows, f"page int, block int, line int, text string, {BOX}"), ["page", "block"])
    assert sorted(r.text for r in kept.collect()) == ["très long ☃", "x=1", "正文"]


def test_items_in_reading_order(spark):
    """Half-even heights; text before figures; drawings under pictures, rules and small ones go."""
    text = spark.createDataFrame([(1, 0, 0, "甲", 10.0, 0.0, 1.5, 9.0, 11.5), (1, 1, 1, "乙", 10.0, 0.0, 2.5, 9.0, 12.5), (1, 2, 2, " ", 10.0, 0.0, 0.0, 1.0, 1.0)], "page int, block int, line int, text string, size double, x0 double, y0 double, x1 double, y1 double")
    pictures = spark.createDataFrame([(1, 1, 0.0, 2.4, 50.0, 60.0), (1, 2, 0.0, 0.0, 30.0, 30.0)], f"page int, n int, {BOX}")
    drawings = spark.createDataFrame([(1, 5.0, 10.0, 45.0, 50.0), (1, 0.0, 200.0, 400.0, 220.0), (1, 0.0, 300.0, 60.0, 340.0), (1, 0.0, 345.0, 60.0, 360.0), (2, 0.0, 0.0, 20.0, 20.0)], f"page int, {BOX}")
    got = [(r.page, r.place, r.kind, r.y0, r.text, r.height) for r in pages.page_items(text, pictures, drawings).orderBy("page", "place").collect()]
    assert got == [(1, 1, "t", 1.5, "甲", None), (1, 2, "t", 2.5, "乙", None), (1, 3, "f", 2.4, None, 57.6), (1, 4, "f", 300.0, None, 60.0)]


def boxes(seed, n, page=lambda rng: 1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x, y, w, h = rng.uniform(0, 900), rng.uniform(0, 900), rng.choice([5, 40, 300]) * rng.random(), rng.choice([5, 40, 300]) * rng.random()
        out.append((page(rng), x, y, x + w, y + h))
    return out


def test_covered_rectangles(spark):
    some, images = boxes(1, 300), boxes(2, 300) + [(1, 0.0, 0.0, 5000.0, 30.0), (None, 0.0, 0.0, 9.0, 9.0)]

    def covered(r, i):
        w, h = max(0, min(r[3], i[3]) - max(r[1], i[1])), max(0, min(r[4], i[4]) - max(r[2], i[2]))
        return r[0] == i[0] and w * h > 0.6 * (r[3] - r[1]) * (r[4] - r[2])

    frame = lambda rows: spark.createDataFrame(rows, f"page int, {BOX}")
    got = blocks.uncovered(frame(some + [(1, None, 0.0, 1.0, 1.0)]), frame(images), "page").collect()
    want = [r for r in some if not any(covered(r, i) for i in images)]
    assert sorted(tuple(r) for r in got if r.x0 is not None) == sorted(want) and len(want) < len(some) and len(got) == len(want) + 1
    assert blocks.uncovered(frame(some), frame([]), "page").count() == 300


def test_one_dense_page_is_linear(spark):
    """All rectangles on one page: cells and the maximum of a scan, not pairs."""
    frame = spark.createDataFrame(boxes(3, 20_000), f"page int, {BOX}").withColumn("line", F.monotonically_increasing_id()).cache()
    bands = spark.createDataFrame([(1, float(i), i + 0.4) for i in range(0, 900, 1)], "page int, lo double, hi double")
    began = time.time()
    assert 0 < blocks.uncovered(frame, frame.where("line % 2 = 0"), "page").count() < 20_000
    assert 0 < blocks.outside_bands(frame, bands, ["page"]).count() < 20_000
    assert blocks.merge_rects(frame, "page").count() > 0
    assert time.time() - began < 120


def test_rectangles_merge_as_a_fold(spark):
    rows = [(1, 0.0, 0.0, 9.0, 5.0), (1, 0.0, 8.0, 9.0, 12.0), (1, 0.0, 30.0, 9.0, 40.0), (2, 0.0, 0.0, 1.0, 1.0), (3, None, 0.0, 1.0, 1.0)]
    got = blocks.merge_rects(spark.createDataFrame(rows, f"page int, {BOX}"), "page").collect()
    assert sorted((r.page, r.n, r.y0, r.y1) for r in got) == [(1, 0, 0.0, 12.0), (1, 1, 30.0, 40.0), (2, 0, 0.0, 1.0)]


def nested(html, name):
    """Elements by a plain counter."""
    open_, out, n = [], [], 0
    for m in re.finditer(rf"<(/?)\s*{name}[^>]*>", html):
        if not m[1]:
            open_.append((n, m.start()))
            n += 1
        elif open_:
            k, start = open_.pop()
            out.append((k, start, m.end()))
    return sorted(out)


def test_every_element_ends(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["<div>", "</div>", "<DIV class='x'>", "t", "<br>", "<p>", "</p>", "<div/>"]) for _ in range(rng.randrange(60))).lower() for _ in range(30)] + ["", "</div></div><div></div>"]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "k int, html string")
    found: dict = {}
    for r in elements.elements(frame, "k").where("name = 'div'").collect():
        found.setdefault(r.k, []).append((r.n, r.start, r.stop))
    for k, t in enumerate(texts):
        assert sorted(found.get(k, [])) == nested(t.replace("<div/>", "######"), "div"), t


def test_slices_and_blocks(spark):
    rows = [(1, "<span>A<i>xy</i>B</span>", 7, 11), (2, "<b>x</b><br>y", 4, 8), (3, "plain", 1, 3), (4, None, 0, 1), (5, "<i>a</i>", 3, 3)]
    got = {r.k: r.html for r in elements.balanced(spark.createDataFrame(rows, "k int, html string, a int, b int"), "k", "html", "a", "b").collect()}
    assert got == {1: "<span><i>x</i></span>", 2: "<b></b>", 3: "la", 4: None, 5: ""}
    frame = spark.createDataFrame([(1, "a<div>b<div>c</div></div>d<div>e</div>f"), (2, "none"), (3, None)], "k int, html string")
    rest, cut = elements.without(frame, "k", "html", elements.elements(frame, "k").select("k", "start", "stop"))
    assert {r.k: r.html for r in rest.collect()} == {1: "adf", 2: "none", 3: None}
    assert sorted((r.n, r.html) for r in cut.collect()) == [(0, "<div>b<div>c</div></div>"), (1, "<div>e</div>")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pagination_rounds(spark, seed):
    rng = random.Random(seed)
    rows = [(d, i, rng.choice("ab"), rng.choice([10, 70, 130, 250])) for d in range(4) for i in range(rng.randrange(1, 40))]
    got = {(r.doc, r.i): (r.occurrence, r.page, r.top, r.breaks) for r in pagination.paginate_by_title(spark.createDataFrame(rows, "doc int, i int, title string, height long"), "doc", "i", 100).collect()}
    for d in range(4):
        own = [(t, h) for doc, _, t, h in rows if doc == d]
        added: set = set()
        for step in range(6):
            page, top, seen, placed = 0, 0, {}, []
            for t, h in own:
                k = seen.get(t, 0)
                seen[t] = k + 1
                if (t, k) in added and top:
                    page, top = page + 1, 0
                placed.append((k, page, top, (t, k) in added))
                page, top = page + (top + h) // 100, (top + h) % 100
            low = {(t, p[0]) for (t, _), p in zip(own, placed, strict=True) if p[2] > 50} - added
            if not low or step == 5:
                break
            added |= low
        assert [got[d, i] for i in range(len(own))] == placed


def test_closure_over_many_rounds(spark):
    steps = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(30, 0), (5, None), (None, 3)], "a int, b int")
    got = markup.closure(spark.createDataFrame([(0,), (0,), (None,)], "k int"), steps)
    assert sorted(r.k for r in got.collect()) == list(range(31))
    assert got._jdf.queryExecution().analyzed().toString().count("\n") < 40
    assert markup.closure(spark.createDataFrame([], "k int"), steps).count() == 0


def test_prefixes_of_any_length(spark):
    names = ["ab STEEL", "ab BRASS", "abc BRASS", "b", "", None, "STEEL"]
    wanted = ["", "a", "ab", "abc", "abc BRASS", "x", None, "abc BRASS and more"]
    got = {r.prefix: r.name for r in catalog.prefix_lookup(spark.createDataFrame([(w,) for w in wanted], "prefix string"), spark.createDataFrame([(n,) for n in names], "name string"), ["STEEL", "BRASS"]).collect()}
    rank = lambda n: ("STEEL" not in n, n)
    usable = [n for n in names if n and ("STEEL" in n or "BRASS" in n)]
    assert got == {w: min((n for n in usable if w is not None and n.startswith(w)), key=rank, default=None) for w in wanted}


def test_catalog_is_read_back(spark):
    rows = [("R1", "one", "N1", "a", b, "p", f"f{b}", "http://u", "pdf") for b in range(25)] + [("R2", "two", None, None, 1, None, "g", "http://v", "bin")]
    frame = spark.createDataFrame(rows, "chapter_id string, chapter string, lesson_id string, lesson string, bundle int, period string, file string, url string, ext string")
    path = shared_path(spark, "catalog")
    catalog_build.write_catalog(frame, path, 10)
    got = catalog_build.read_catalog(spark, path)
    assert sorted((r.chapter_id, r.lesson_id or "", r.part, r.place, r.file) for r in got.collect()) == [("R1", "N1", (i // 10), i + 1, f"f{i}") for i in range(25)] + [("R2", "", 0, 1, "g")]
    assert max(len(r.resources) for r in spark.read.json(path).collect()) == 10


def test_media_and_answers(spark):
    frame = spark.createDataFrame([(1, 'a<img src="media/x.png">b<img src="media/no.png"><img src="media/x.png">'), (2, "none"), (3, None)], "k int, html string")
    media = spark.createDataFrame([("x.png", "image/png", bytearray(b"\x00\x01" * 40))], "name string, mime string, content binary")
    got = {r.k: (r.html, r.missing) for r in lines.inlined(frame, media, "k", "html").collect()}
    uri = "data:image/png;base64," + __import__("base64").b64encode(b"\x00\x01" * 40).decode()
    assert got == {1: (f'a<img src="{uri}">b<img src=""><img src="{uri}">', ["no.png"]), 2: ("none", []), 3: (None, [])}
    tasks = spark.createDataFrame([(1,), (2,), (3,)], "task int")
    own = spark.createDataFrame([(1, "mine"), (2, " ")], "task int, answer string")
    library = spark.createDataFrame([(1, "lib"), (2, "lib"), (3, None)], "task int, answer string")
    assert sorted(tuple(r) for r in lines.answered(tasks, own, library, "略").collect()) == [(1, "mine", "own"), (2, "lib", "library"), (3, "略", "none")]


def test_line_rules(spark):
    cases = {"什么？": (False, False), "是什么？": (True, False), "填_____空": (True, False), "思考1：为什么": (True, False), "1.什么是电流": (True, False), "1.电流是。": (False, False), "A．甲": (False, True), "如 A．甲甲甲甲 B．乙": (False, True), "A 点": (False, False), None: (False, False)}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", F.coalesce(lines.needs_answer(F.col("t")), F.lit(False)).alias("a"), F.coalesce(lines.has_option(F.col("t")), F.lit(False)).alias("o")).collect()
    assert {r.t: (r.a, r.o) for r in rows} == cases


def test_closure_broadcasts_no_table(spark, monkeypatch):
    """A broadcast goes through the driver, in every round again."""
    plans, durable = [], markup.durable

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return durable(df)

    monkeypatch.setattr(markup, "durable", seen)
    steps = spark.createDataFrame([(k, k + 1) for k in range(12)], "a int, b int")
    assert markup.closure(spark.createDataFrame([(0,)], "k int"), steps).count() == 13
    assert len(plans) > 12 and not any("Broadcast" in p for p in plans)


def test_formulas_are_set_row_by_row(spark):
    from lessonweave.functions import mathx
    from lessonweave.functions import text as fn

    rows = spark.createDataFrame([(1, "a<b $x_{1}$ and $x_{1}$"), (2, "\\sqrt{2}"), (3, "$ 5"), (4, None)], "k int, t string")
    found = elements.with_formulas(rows, "k", "t", mathx.latex_htmls, fn.escape_html)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    x = '<span class="m">x<sub>1</sub></span>'
    got = {r.k: r.html for r in found.collect()}
    assert got.pop(2).startswith('<span class="m">√')
    assert got == {1: f"a&lt;b {x} and {x}", 3: "$ 5", 4: ""}


def test_slices_are_dealt_to_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(elements, "TASK_ROWS", 10)
    rows = spark.createDataFrame([(k, f"<p>{k}</p>", 3, 4) for k in range(200)], "k int, html string, a int, b int")
    assert elements._dealt(rows, "k", "html").rdd.getNumPartitions() == 20
    assert {r.html for r in elements.balanced(rows, "k", "html", "a", "b").collect()} == {f"<p>{str(k)[0]}</p>" for k in range(200)}


def test_page_items_are_computed_once(spark):
    from lessonweave.operators import pages

    lines = spark.createDataFrame([(1, 0, 0, "题", 0.0, 10.0, 0.0, 50.0, 10.0)], "page int, block int, line int, text string, y0 double, y1 double, x0 double, x1 double, size double")
    box = "x0 double, y0 double, x1 double, y1 double"
    found = pages.page_items(lines, spark.createDataFrame([(1, 5, 0.0, 20.0, 50.0, 60.0)], f"page int, n long, {box}"), spark.createDataFrame([], f"page int, {box}"))
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r.kind for r in found.orderBy("place").collect()] == ["t", "f"]
