"""Queries on lesson titles, answer lines and their markup over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lessonweave.functions import lessons as fn
from lessonweave.functions import mathx as math
from lessonweave.functions import text as text_fn
from lessonweave.operators import elements
from lessonweave.operators.sectioning import is_value, trimmed
from lessonweave.plans.common import collection
from lessonweave.sources.tables import read

QUERIES, SQL, query = collection()


_s = lambda c: F.col(c).cast("string")


def _turn(key, *values):
    """One of the values by the key's remainder."""
    out = F.when(F.lit(False), F.lit(""))
    for k, v in enumerate(values):
        out = out.when(key % len(values) == k, v)
    return out


_LINES = "CASE o_orderkey % 6 WHEN 0 THEN ' 1．' || o_custkey WHEN 1 THEN '2. AC' WHEN 2 THEN '3.由$x$' WHEN 3 THEN 'stem ' || o_custkey WHEN 4 THEN '12、(3)' || o_custkey ELSE '4．哪个 ' || o_custkey END"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    c = _s("o_custkey")
    text = _turn(F.col("o_orderkey"), F.concat(F.lit(" 1．"), c), F.lit("2. AC"), F.lit("3.由$x$"), F.concat(F.lit("stem "), c), F.concat(F.lit("12、(3)"), c), F.concat(F.lit("4．哪个 "), c))
    return read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", text.alias("line"))


@query(rf"""
WITH l AS (SELECT o_orderkey, trim(line) AS t FROM (SELECT o_orderkey, {_LINES} AS line FROM orders)),
b AS (SELECT o_orderkey, regexp_matches(t, '^\d{{1,2}}\s*[.．、]\s*\S') AS numbered, regexp_replace(t, '^\d{{1,2}}\s*[.．、]\s*', '') AS body FROM l)
SELECT o_orderkey, numbered AND (regexp_matches(body, '^[-−+]?\d') OR regexp_matches(body, '^\\?[A-Za-z_$]') OR regexp_matches(body, '^[(（]\d{{1,2}}[)）]') OR list_contains(['由', '因', '解', '答', '故', '选', '设', '当', '若', '则'], left(body, 1)) OR starts_with(body, '根据')) AS is_answer FROM b
""")
def answer_line_predicate(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).select("o_orderkey", is_value(trimmed(F.col("line"))).alias("is_answer"))


@query(rf"""
WITH b AS (SELECT o_custkey AS doc, o_orderkey AS ord, CASE WHEN o_orderkey % 7 = 0 THEN '答案：' WHEN o_orderkey % 31 = 0 THEN '课后练习' ELSE {_LINES} END AS line FROM orders),
a AS (SELECT doc, min(ord) AS at FROM b WHERE line LIKE '答案%' GROUP BY doc)
SELECT a.doc, CASE WHEN bool_or(coalesce(line LIKE '课后练习%', false)) THEN NULL ELSE max(ord) FILTER (regexp_matches(trim(line), '^\d{{1,2}}\s*[.．、]')) END AS zone
FROM a LEFT JOIN b ON b.doc = a.doc AND b.ord < a.at GROUP BY a.doc
""")
def answer_zone_start(spark: SparkSession, d: str) -> DataFrame:
    """The last question before a document's first answer mark; none if the exercise title stands before it. One window, no join."""
    key = F.col("o_orderkey")
    line = F.when(key % 7 == 0, fn.ANSWER_MARK + "：").when(key % 31 == 0, fn.EXERCISE_TITLE).otherwise(F.col("line"))
    blocks = _lines(spark, d).select(F.col("o_custkey").alias("doc"), key.alias("ord"), line.alias("line"))
    first = F.min(F.when(F.startswith("line", F.lit(fn.ANSWER_MARK)), F.col("ord"))).over(Window.partitionBy("doc"))
    marked = blocks.withColumn("at", first).where("at IS NOT NULL")
    before = F.col("ord") < F.col("at")
    asked = F.max(F.when(before & F.trim("line").rlike(fn.QUESTION_NUMBER), F.col("ord")))
    titled = F.coalesce(F.max(before & F.startswith("line", F.lit(fn.EXERCISE_TITLE))), F.lit(False))
    return marked.groupBy("doc").agg(F.when(~titled, asked).alias("zone"))


@query(r"""
WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'media\11-' || p_partkey || '.TIF' WHEN 1 THEN 'a/左括.png' WHEN 2 THEN 'a\b/' || p_name || '.jpg' END AS target FROM part),
b AS (SELECT p_partkey, target, regexp_replace(regexp_extract(target, '([^/\\]*)$', 1), '(?i)\.(tif|png|jpg|jpeg|emf|wmf)$', '') AS base FROM p)
SELECT p_partkey, CASE WHEN target IS NULL OR regexp_matches(base, '^[\d—-]+$') THEN 'figure' WHEN base LIKE '%左括%' OR base LIKE '%右括%' THEN 'decoration' ELSE 'text' END AS kind, base AS text FROM b
""")
def picture_kinds(spark: SparkSession, d: str) -> DataFrame:
    target = F.when(F.col("p_partkey") % 4 == 3, F.lit(None)).otherwise(_turn(F.col("p_partkey"), F.concat(F.lit("media\\11-"), _s("p_partkey"), F.lit(".TIF")), F.lit("a/左括.png"), F.concat(F.lit("a\\b/"), F.col("p_name"), F.lit(".jpg")), F.lit(None)))
    return read(spark, d, "part").select("p_partkey", fn.picture_kind(target).alias("kind"), fn.picture_text(target).alias("text"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE contains(CAST(o_orderkey AS VARCHAR), '42')")
def worklist_filter(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").where(F.contains(_s("o_orderkey"), F.lit("42"))).select("o_orderkey", "o_custkey")


@query("SELECT conv_id, turn, role FROM conversations WHERE NOT (role = 'user' AND trim(coalesce(CASE WHEN turn % 4 = 0 THEN '' ELSE text END, '')) = '')")
def dead_zone_drop(spark: SparkSession, d: str) -> DataFrame:
    """Headings without a title go."""
    title = F.trim(F.coalesce(F.when(F.col("turn") % 4 == 0, "").otherwise(F.col("text")), F.lit("")))
    return read(spark, d, "conversations").where(~((F.col("role") == "user") & (title == ""))).select("conv_id", "turn", "role")


@query("SELECT o_orderkey AS job, c_name AS course, c_nationkey AS place FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def course_details(spark: SparkSession, d: str) -> DataFrame:
    """Jobs with the details of their course; a job whose course gave none is left out."""
    details = read(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", F.col("c_name").alias("course"), F.col("c_nationkey").alias("place"))
    return read(spark, d, "orders").join(details, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("job"), "course", "place")


@query("""
WITH q AS (SELECT o_orderkey AS task, 'Lesson　' || (o_custkey % 40) || ' of ' || o_orderstatus AS title, o_custkey % 9 AS no FROM orders),
a AS (SELECT c_custkey AS ord, CASE WHEN c_custkey % 2 = 0 THEN 'Lesson　' || (c_custkey % 40) || ' of F' ELSE 'Lesson ' || (c_custkey % 40) || '  of　O' END AS title, c_custkey % 9 AS no, c_name AS answer FROM customer),
e AS (SELECT title, no, min_by(answer, ord) AS answer FROM a GROUP BY 1, 2),
n AS (SELECT regexp_replace(title, '[\\s　]+', '', 'g') AS bare, no, min_by(answer, ord) AS answer FROM a GROUP BY 1, 2)
SELECT q.task, regexp_replace(q.title, '[\\s　]+', ' ', 'g') AS lesson, coalesce(e.answer, n.answer) AS answer FROM q LEFT JOIN e ON e.title = q.title AND e.no = q.no LEFT JOIN n ON n.bare = regexp_replace(q.title, '[\\s　]+', '', 'g') AND n.no = q.no
""".replace("\\\\", "\\"))
def title_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Answers by title and number, else by the title without its spaces; the first of several."""
    key = F.col("c_custkey")
    even = F.concat(F.lit("Lesson　"), (key % 40).cast("string"), F.lit(" of F"))
    odd = F.concat(F.lit("Lesson "), (key % 40).cast("string"), F.lit("  of　O"))
    answers = read(spark, d, "customer").select(F.when(key % 2 == 0, even).otherwise(odd).alias("title"), (key % 9).alias("no"), key.alias("ord"), F.col("c_name").alias("answer"))
    exact = answers.groupBy("title", "no").agg(F.min_by("answer", "ord").alias("exact"))
    bare = answers.groupBy(fn.spaceless(F.col("title")).alias("bare"), "no").agg(F.min_by("answer", "ord").alias("loose"))
    title = F.concat(F.lit("Lesson　"), (F.col("o_custkey") % 40).cast("string"), F.lit(" of "), F.col("o_orderstatus"))
    tasks = read(spark, d, "orders").select(F.col("o_orderkey").alias("task"), title.alias("title"), (F.col("o_custkey") % 9).alias("no")).withColumn("bare", fn.spaceless(F.col("title")))
    found = tasks.join(exact, ["title", "no"], "left").join(bare, ["bare", "no"], "left")
    return found.select("task", fn.lesson_key(F.col("title")).alias("lesson"), F.coalesce("exact", "loose").alias("answer"))


@query("""
WITH g AS (SELECT o_custkey AS folder, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '第二' WHEN 2 THEN '第一' ELSE '第三' END AS period, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT folder, period, n, row_number() OVER (PARTITION BY folder ORDER BY CASE WHEN period = '' THEN '0' ELSE period END) AS place FROM g
""")
def period_order(spark: SparkSession, d: str) -> DataFrame:
    """Blank periods first, then by code point."""
    period = _turn(F.col("o_orderkey"), F.lit(""), F.lit("第二"), F.lit("第一"), F.lit("第三"))
    groups = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("folder"), period.alias("period")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("folder").orderBy(F.when(F.col("period") == "", "0").otherwise(F.col("period")))
    return groups.withColumn("place", F.row_number().over(order))


@query("""
SELECT p_partkey, regexp_replace(p_name, '\\s+', '', 'g') || CASE WHEN p_partkey % 2 = 0 THEN '.1' ELSE '' END AS name FROM part
""".replace("\\\\", "\\"))
def document_names(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("/a b/"), F.col("p_name"), F.when(F.col("p_partkey") % 2 == 0, ".1 (3).docx").otherwise("　(12).docx"))
    return read(spark, d, "part").select("p_partkey", fn.document_name(path).alias("name"))


_TAGS_SQL = r"""
WITH g AS (SELECT page_id, regexp_extract_all(html, '<\s*/?\s*div[^>]*>') AS ts, string_split_regex(html, '<\s*/?\s*div[^>]*>') AS gs FROM pages),
e AS (SELECT page_id, i, ts[i] AS tag, list_sum(list_transform(gs[1 : i], lambda x: length(x))) + list_sum(list_transform(ts[1 : i], lambda x: length(x))) AS stop FROM g, unnest(range(1, len(ts) + 1)) AS u(i)),
t AS (SELECT page_id, i, CASE WHEN regexp_matches(tag, '^<\s*/') THEN -1 ELSE 1 END AS step, CAST(stop AS BIGINT) AS stop, CAST(stop - length(tag) AS BIGINT) AS start FROM e),
o AS (SELECT a.page_id, a.i, a.start, b.stop, sum(b.step) OVER (PARTITION BY a.page_id, a.i ORDER BY b.i) AS open FROM t a JOIN t b ON b.page_id = a.page_id AND b.i >= a.i WHERE a.step = 1),
d AS (SELECT page_id, i, start, min(stop) AS stop FROM o WHERE open = 0 GROUP BY 1, 2, 3)
"""


@query(_TAGS_SQL + "SELECT d.page_id, d.start, d.stop, (SELECT count(*) FROM d x WHERE x.page_id = d.page_id AND x.start <= d.start AND x.stop >= d.stop) AS depth FROM d")
def div_spans(spark: SparkSession, d: str) -> DataFrame:
    """Where every div begins and ends, inner ones too, and how deep it lies."""
    return elements.elements(read(spark, d, "pages").select("page_id", "html"), "page_id").where("name = 'div'").select("page_id", "start", "stop", "depth")


@query(_TAGS_SQL + "SELECT page_id, min_by(stop, start) AS div_end FROM d GROUP BY 1")
def div_ends(spark: SparkSession, d: str) -> DataFrame:
    """Where a page's first div ends, behind those that it holds."""
    spans = elements.elements(read(spark, d, "pages").select("page_id", "html"), "page_id").where("name = 'div'")
    return spans.groupBy("page_id").agg(F.min_by("stop", "start").alias("div_end"))


@query(
    _TAGS_SQL
    + """, top AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM d x WHERE x.page_id = d.page_id AND (x.start < d.start AND x.stop > d.stop))),
b AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY start) - 1 AS n, substr(html, start + 1, stop - start) AS html FROM top JOIN pages USING (page_id))
SELECT page_id, CAST(n AS INTEGER) AS n, length(html) AS n_chars, md5(html) AS digest FROM b"""
)
def isolated_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The outermost divs of each page, cut out."""
    pages = read(spark, d, "pages").select("page_id", "html")
    spans = elements.elements(pages, "page_id").where("name = 'div'").select("page_id", "start", "stop")
    _, blocks = elements.without(pages, "page_id", "html", spans)
    return blocks.select("page_id", "n", F.length("html").cast("long").alias("n_chars"), F.md5("html").alias("digest"))


@query("SELECT page_id, md5(replace(html, '<p>', '<p class=\"head\">')) AS digest FROM pages")
def spliced_heads(spark: SparkSession, d: str) -> DataFrame:
    """Every paragraph's start tag is replaced at its place."""
    parts = F.transform(F.split("html", "<p>", -1), lambda x: F.length(x))
    ends = F.slice(parts, F.lit(1), F.size(parts) - 1)
    places = F.transform(ends, lambda x, i: F.aggregate(F.slice(parts, F.lit(1), i + 1), F.lit(0), lambda a, b: a + b) + 3 * i)
    return read(spark, d, "pages").select("page_id", F.md5(fn.splice(F.col("html"), places, '<p class="head">', 3)).alias("digest"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'a&lt;' || o_custkey || ' <span class="m">x<sub>' || o_custkey || '</sub></span> end' WHEN 1 THEN '<span class="m">√(' || o_custkey || ')</span>' ELSE 'plain ' || o_custkey || ' $' END AS html FROM orders
""")
def answer_formulas(spark: SparkSession, d: str) -> DataFrame:
    c = _s("o_custkey")
    text = _turn(F.col("o_orderkey"), F.concat(F.lit("a<"), c, F.lit(" $x_{"), c, F.lit("}$ end")), F.concat(F.lit("\\sqrt{"), c, F.lit("}")), F.concat(F.lit("plain "), c, F.lit(" $")))
    return elements.with_formulas(read(spark, d, "orders").select("o_orderkey", text.alias("text")), "o_orderkey", "text", math.latex_htmls, text_fn.escape_html)


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '<span><i>' || o_custkey || '</i>B</span>' ELSE '<b>' || substr(CAST(o_custkey AS VARCHAR), 2) || '</b><br>x' END AS html FROM orders
""")
def balanced_slices(spark: SparkSession, d: str) -> DataFrame:
    c = _s("o_custkey")
    even, odd = F.concat(F.lit("<span>A<i>"), c, F.lit("</i>B</span>")), F.concat(F.lit("<b>"), c, F.lit("</b><br>x"))
    is_even = F.col("o_orderkey") % 2 == 0
    html = F.when(is_even, even).otherwise(odd)
    start, end = F.when(is_even, 7).otherwise(4), F.when(is_even, F.length(c) + 15).otherwise(F.length(html))
    return elements.balanced(read(spark, d, "orders").select("o_orderkey", html.alias("whole"), start.alias("start"), end.alias("stop")), "o_orderkey", "whole", "start", "stop")


@query("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '<img src="a.png"> Find ' || o_custkey WHEN 1 THEN '<b></b>Find ' || o_custkey ELSE 'Find 3. ' || o_custkey END AS html FROM orders
""")
def number_cut(spark: SparkSession, d: str) -> DataFrame:
    c = _s("o_custkey")
    html = _turn(F.col("o_orderkey"), F.concat(F.lit('<img src="a.png"> 12．Find '), c), F.concat(F.lit("<b></b>3. Find "), c), F.concat(F.lit("Find 3. "), c))
    return read(spark, d, "orders").select("o_orderkey", fn.without_number(html).alias("html"))
