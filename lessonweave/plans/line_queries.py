"""Queries on lines of worksheets, pictures, formulas and task answers over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.operators import lines as op
from lessonweave.plans.answer_queries import SQL as _ANSWER_SQL
from lessonweave.plans.answer_queries import answer_library_match
from lessonweave.plans.common import collection
from lessonweave.plans.sequence_queries import lines
from lessonweave.sources.tables import read

QUERIES, SQL, query = collection()

#: What a line is dressed as, by its length and place; ``*`` is the line, ``#`` its first twelve characters.
SHAPES = [
    "*", "*？", "1.#", "(2)#", "3．*。", "思考1：*", "讨论 ：#", "#___#", "#＿＿＿", "#　　　　　　#", "A．#", "说 A．# B．# 完", "A．甲。 B．乙", "<b>Ｃ</b>、#", "U=#", "2.I ＝#", "|φ| = *", "x#=", "课题 #", "0815QJ#", " 物理 ", "10", "学 科", "4）#；",
]


def _dressed(spark: SparkSession, d: str) -> DataFrame:
    rows = lines(spark, d).where("text IS NOT NULL")
    k = F.pmod(F.length("text") * 5 + F.col("idx"), F.lit(len(SHAPES))).cast("int")
    shape = F.element_at(F.array(*[F.lit(s) for s in SHAPES]), k + 1)
    return rows.select("doc_id", "idx", F.replace(F.replace(shape, F.lit("*"), F.col("text")), F.lit("#"), F.left("text", F.lit(12))).alias("text"))


_SHAPES_SQL = "[" + ", ".join(f"'{s}'" for s in SHAPES) + "]"
_LINES = f"""
WITH l0 AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), l1 AS (SELECT doc_id, unnest(ls) AS raw, CAST(unnest(generate_series(0, len(ls) - 1)) AS INTEGER) AS idx FROM l0),
l AS (SELECT doc_id, idx, replace(replace(({_SHAPES_SQL})[CAST((length(raw) * 5 + idx) % {len(SHAPES)} AS INTEGER) + 1], '*', raw), '#', left(raw, 12)) AS text FROM l1),
t AS (SELECT *, regexp_replace(text, '^[\\s　]+|[\\s　]+$', '', 'g') AS t, regexp_replace(regexp_replace(text, '<[^>]+>', '', 'g'), '^[\\s　]+|[\\s　]+$', '', 'g') AS p FROM l)
"""


@query(
    _LINES
    + r"""SELECT doc_id, idx, length(t) >= 4 AND (regexp_matches(t, '[?？]$') OR contains(t, '___') OR contains(t, '＿＿＿') OR regexp_matches(t, '[ 　]{6}') OR regexp_matches(t, '^(思考|想一想|做一做|试一试|议一议|讨论)\s*[0-9]*\s*[:：]')
  OR (regexp_matches(t, '^[（(]?[0-9]{1,2}[）).．、]') AND length(t) <= 40 AND NOT regexp_matches(t, '[。！；;]$'))) AS needs_answer,
  regexp_matches(p, '^[A-DＡ-Ｄ]\s*[.、．]') OR regexp_matches(p, '[A-DＡ-Ｄ]\s*[.、．][^。]{4,40}?[A-DＡ-Ｄ]\s*[.、．]') AS option,
  regexp_matches(regexp_replace(regexp_replace(t, '^[0-9]+\s*[.、．]\s*', ''), '<[^>]+>', '', 'g'), '^[A-Za-z0-9=𝑊φ|]+\s*[=＝]') AND length(regexp_replace(regexp_replace(t, '^[0-9]+\s*[.、．]\s*', ''), '<[^>]+>', '', 'g')) < 80 AS sheet_equation,
  regexp_matches(p, '^[A-Za-z0-9φ𝑈|]+\s*[=＝]') AND length(p) < 90 AS slide_equation,
  idx < 20 AND (regexp_matches(text, '课程基本信息|课例编号|学生信息|课题|姓名|出版社|书名|教科书|学期|学科|年级|出版日期') OR regexp_matches(text, '^[0-9]{4}QJ') OR t IN ('学', '科', '10', '物理')) AS header FROM t"""
)
def line_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Whether each line asks for an answer, is an option or an equation, or belongs to the first page's header; twenty lines make a page."""
    t = F.col("text")
    return _dressed(spark, d).select(
        "doc_id", "idx", op.needs_answer(t).alias("needs_answer"), op.has_option(t).alias("option"), op.is_equation(t).alias("sheet_equation"), op.is_equation(t, slide=True).alias("slide_equation"), op.is_header(t, F.floor(F.col("idx") / 20)).alias("header")
    )


@query(_LINES + r"SELECT doc_id, idx // 8 AS question, bool_or(regexp_matches(p, '^[A-DＡ-Ｄ]\s*[.、．]') OR regexp_matches(p, '[A-DＡ-Ｄ]\s*[.、．][^。]{4,40}?[A-DＡ-Ｄ]\s*[.、．]')) AS has_options FROM t GROUP BY 1, 2")
def questions_with_options(spark: SparkSession, d: str) -> DataFrame:
    """Whether any line of a question holds options; eight lines make a question."""
    return _dressed(spark, d).groupBy("doc_id", F.floor(F.col("idx") / 8).alias("question")).agg(F.bool_or(op.has_option(F.col("text"))).alias("has_options"))


@query(r"SELECT page_id, md5(html) AS digest FROM pages")
def captions_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Every paragraph gets a caption before it, by its page, and loses it again."""
    number = (F.col("page_id") % 97).cast("string")
    html = F.replace(F.col("html"), F.lit("<p>"), F.concat(F.lit("<p> 图 "), number, F.lit(" </p><p>")))
    return read(spark, d, "pages").select("page_id", F.md5(op.without_captions(html)).alias("digest"))


@query(r"""
WITH r AS (SELECT page_id, regexp_replace(html, 'href="/([^"]*)"', 'src="media/\1.png"', 'g') AS html FROM pages),
x AS (SELECT page_id, string_split_regex(html, 'src="media/[^"]+"') AS gaps, regexp_extract_all(html, 'src="media/([^"]+)"', 1) AS names FROM r),
m AS (SELECT lower(split_part(p_name, ' ', 1)) || '.png' AS name, min(p_type) AS content FROM part GROUP BY 1),
n AS (SELECT page_id, i, gaps[i] AS gap, names[i] AS name FROM x, unnest(range(1, len(gaps) + 1)) AS u(i)),
j AS (SELECT n.*, 'data:image/png;base64,' || to_base64(encode(content)) AS uri FROM n LEFT JOIN m USING (name))
SELECT page_id, md5(string_agg(gap || CASE WHEN name IS NULL THEN '' ELSE 'src="' || coalesce(uri, '') || '"' END, '' ORDER BY i)) AS digest, coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (name IS NOT NULL AND uri IS NULL), '') AS missing FROM j GROUP BY page_id
""")
def inline_media(spark: SparkSession, d: str) -> DataFrame:
    """Links as pictures, parts' types as their bytes: data URIs where there are bytes, and the names of the rest."""
    pages = read(spark, d, "pages").select("page_id", F.regexp_replace("html", 'href="/([^"]*)"', 'src="media/$1.png"').alias("html"))
    name = F.concat(F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))), F.lit(".png"))
    media = read(spark, d, "part").groupBy(name.alias("name")).agg(F.encode(F.min("p_type"), "UTF-8").alias("content")).withColumn("mime", F.lit("image/png"))
    return op.inlined(pages, media, "page_id", "html").select("page_id", F.md5("html").alias("digest"), F.array_join("missing", ",").alias("missing"))


@query("""
WITH f AS (SELECT l_orderkey AS doc, l_linenumber AS pos, l_partkey, l_suppkey, 'x_{' || l_partkey % 40 || '}' AS tex FROM lineitem),
c AS (SELECT 'x_{' || c_nationkey || '}' AS decoded, min('\\\\chi_{' || c_custkey || '}') AS fixed FROM customer WHERE c_acctbal < 0 GROUP BY 1)
SELECT doc, pos, l_partkey, l_suppkey, coalesce(c.fixed, tex) AS tex, c.fixed IS NOT NULL AS fixed FROM f LEFT JOIN c ON decoded = tex
""".replace("\\\\\\\\", "\\\\").replace("\\\\", "\\"))
def formula_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Decoded formulas by what they should read; customers with debts are the corrections."""
    brace = lambda head, c: F.concat(F.lit(head), c.cast("string"), F.lit("}"))
    formulas = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("pos"), "l_partkey", "l_suppkey", brace("x_{", F.col("l_partkey") % 40).alias("tex"))
    corrections = read(spark, d, "customer").where("c_acctbal < 0").select(brace("x_{", F.col("c_nationkey")).alias("decoded"), brace("\\chi_{", F.col("c_custkey")).alias("right"))
    return op.corrected(formulas, corrections)


_LIBRARY_SQL = _ANSWER_SQL["answer_library_match"]


@query(
    f"""
WITH lib AS ({_LIBRARY_SQL}), own AS (SELECT l_orderkey AS task, min(CASE WHEN l_linenumber % 3 = 0 THEN 'own ' || l_partkey END) AS answer FROM lineitem GROUP BY 1)
SELECT lib.task, coalesce(own.answer, lib.answer, '略') AS answer, CASE WHEN own.answer IS NOT NULL THEN 'own' WHEN lib.answer IS NOT NULL THEN 'library' ELSE 'none' END AS source FROM lib LEFT JOIN own ON own.task = lib.task
"""
)
def task_answers(spark: SparkSession, d: str) -> DataFrame:
    """A task's own answer, else the library's by lesson, title and cue, else a notice. Blank own answers count as none."""
    library = answer_library_match(spark, d)
    own = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("task"), F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("own "), F.col("l_partkey").cast("string"))).otherwise(" ").alias("answer"))
    return op.answered(library, own, library, "略")
