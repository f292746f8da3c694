"""Queries with small per-value Python functions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.functions import mathx
from lessonweave.plans.common import collection
from lessonweave.sources.tables import read

QUERIES, SQL, query = collection()


_s = lambda c: F.col(c).cast("string")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_partkey || '/(2' || l_suppkey || '<sup>2</sup>)' ELSE 'x<sub>' || l_partkey || '</sub>≤√(' || l_suppkey || ')' END AS html FROM lineitem
""")
def latex_to_html(spark: SparkSession, d: str) -> DataFrame:
    even = F.concat(F.lit("\\frac{"), _s("l_partkey"), F.lit("}{2 {"), _s("l_suppkey"), F.lit("}^2}"))
    odd = F.concat(F.lit("x_{"), _s("l_partkey"), F.lit("} \\le \\sqrt{"), _s("l_suppkey"), F.lit("}"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", mathx.latex_html(F.when(F.col("l_linenumber") % 2 == 0, even).otherwise(odd)).alias("html"))


@query(r"""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '\frac{' || o_orderkey || '}{' || o_custkey || '_{1}}' ELSE '\sqrt{(' || o_orderkey || ')^{2}}' END AS tex FROM orders
""")
def omml_to_latex(spark: SparkSession, d: str) -> DataFrame:
    ns = '<m:oMath xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math">'
    run = lambda c: F.concat(F.lit("<m:r><m:t>"), c, F.lit("</m:t></m:r>"))
    a, b = _s("o_orderkey"), _s("o_custkey")
    fraction = F.concat(F.lit(ns + "<m:f><m:num>"), run(a), F.lit("</m:num><m:den><m:sSub><m:e>"), run(b), F.lit("</m:e><m:sub>"), run(F.lit("1")), F.lit("</m:sub></m:sSub></m:den></m:f></m:oMath>"))
    root = F.concat(F.lit(ns + "<m:rad><m:deg/><m:e><m:sSup><m:e><m:d><m:e>"), run(a), F.lit("</m:e></m:d></m:e><m:sup>"), run(F.lit("2")), F.lit("</m:sup></m:sSup></m:e></m:rad></m:oMath>"))
    return read(spark, d, "orders").select("o_orderkey", mathx.omml_latex(F.when(F.col("o_orderkey") % 2 == 0, fraction).otherwise(root)).alias("tex"))


@query(r"""
WITH t AS (SELECT page_id, regexp_extract_all(html, '<[^>]*>|&#?\w+;|[\s\S]') AS m FROM pages),
u AS (SELECT page_id, unnest(m) AS tok, generate_subscripts(m, 1) AS i FROM t),
o AS (SELECT page_id, i, tok, sum(length(tok)) OVER (PARTITION BY page_id ORDER BY i) - length(tok) AS place FROM u)
SELECT page_id, count(*) AS n, CAST(sum(place) AS BIGINT) AS at_sum, md5(string_agg(CASE tok WHEN '&copy;' THEN '©' WHEN '&middot;' THEN '·' WHEN '&amp;' THEN '&' WHEN '&lt;' THEN '<' WHEN '&gt;' THEN '>' WHEN '&quot;' THEN '"' WHEN '&nbsp;' THEN chr(160) ELSE tok END, '' ORDER BY i)) AS digest
FROM o WHERE tok NOT LIKE '<_%' GROUP BY page_id
""")
def html_offset_map(spark: SparkSession, d: str) -> DataFrame:
    found = read(spark, d, "pages").select("page_id", mathx.html_offsets(F.col("html")).alias("m"))
    total = F.aggregate("m.at", F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("page_id", F.size("m.at").cast("long").alias("n"), total.alias("at_sum"), F.md5("m.plain").alias("digest"))


@query("""
SELECT o_orderkey, 'Order ' || o_orderkey || ' $A.$' AS stem, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 3 END AS INTEGER) AS n, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'C.' || o_custkey END AS last FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, 'Order ' || o_orderkey || ' $A.$ 0.85ΩB.' || o_orderpriority, 0, NULL FROM orders WHERE o_orderkey % 3 = 0
""")
def option_splitter(spark: SparkSession, d: str) -> DataFrame:
    head = F.concat(F.lit("Order "), _s("o_orderkey"), F.lit(" $A.$ "))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(head, F.lit("0.85ΩB."), "o_orderpriority")).otherwise(F.concat(head, F.lit("A．"), "o_orderpriority", F.lit(" B.x C."), _s("o_custkey")))
    found = read(spark, d, "orders").select("o_orderkey", mathx.question_options(text).alias("q"))
    return found.select("o_orderkey", "q.stem", F.size("q.options").alias("n"), F.try_element_at("q.options", F.lit(-1)).alias("last"))
