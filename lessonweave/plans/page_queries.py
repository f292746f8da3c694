"""Queries on whole pages over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.operators import pages as op
from lessonweave.operators import pagination
from lessonweave.plans.common import collection
from lessonweave.plans.sequence_queries import lines
from lessonweave.sources.tables import read

QUERIES, SQL, query = collection()

_PAGES = 1000
_LINES = "WITH RECURSIVE l0 AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), lines AS (SELECT doc_id, unnest(ls) AS text, CAST(unnest(generate_series(0, len(ls) - 1)) AS INTEGER) AS idx FROM l0)"


@query(
    _LINES
    + r""", l AS (SELECT doc_id AS page, idx // 6 AS block, idx AS line, length(text) AS n, CASE length(text) % 4 WHEN 0 THEN '题' || text WHEN 1 THEN left(text, 5) WHEN 2 THEN text || '。' ELSE text || '文' END AS text FROM lines),
g AS (SELECT page, block, line, text, idx2 * 18.0 + n % 9 AS y0, idx2 * 18.0 + n % 9 + 10 AS y1, CAST(n % 50 * 4 AS DOUBLE) AS x0, CAST(n % 50 * 4 + least(n, 120) AS DOUBLE) AS x1, 10.0 AS size FROM (SELECT *, line * 1.0 - CASE WHEN n % 7 = 0 THEN 0.875 ELSE 0 END AS idx2 FROM l)),
r AS (SELECT l_orderkey % 1000 AS page, l_quantity * 8 AS x0, l_linenumber * 30.0 + l_orderkey // 1000 % 40 * 9 AS y0, l_quantity * 8 + l_partkey % 90 + 5 AS x1, l_linenumber * 30.0 + l_orderkey // 1000 % 40 * 9 + l_suppkey % 40 + 4 AS y1, l_suppkey % 2 = 0 AS picture, ((CAST(l_orderkey AS BIGINT) * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey AS n FROM lineitem),
solid AS (SELECT * FROM g WHERE trim(text) <> ''),
tops AS (SELECT page, block, min(y0) AS y0 FROM solid GROUP BY 1, 2),
prose AS (SELECT page, block, y0 - 2 AS lo, y1 + 2 AS hi, x1 FROM solid WHERE regexp_matches(text, '[一-鿿]')),
kept AS (SELECT * FROM solid s WHERE NOT (NOT regexp_matches(text, '[一-鿿]') AND (regexp_matches(trim(text), '^[\w=＋\-*/±×÷≤≥<>φθ.()]{1,6}$') OR regexp_matches(trim(text), '^[\x00-\x7f]+$'))
  AND (coalesce((SELECT max(x1) FROM prose p WHERE p.page = s.page AND p.block = s.block), 0) > 0 AND x0 > (SELECT max(x1) FROM prose p WHERE p.page = s.page AND p.block = s.block) + 1
    OR NOT EXISTS (SELECT 1 FROM prose p WHERE p.page = s.page AND p.block = s.block AND s.y0 + 0.6 * (s.y1 - s.y0) BETWEEN p.lo AND p.hi)))),
k AS (SELECT *, CASE WHEN y0 - lag(y1) OVER w > 13.5 THEN 1 ELSE 0 END AS b, lag(text) OVER w AS prev FROM kept WINDOW w AS (PARTITION BY page, block ORDER BY y0, line)),
p AS (SELECT *, sum(b) OVER (PARTITION BY page, block ORDER BY y0, line ROWS UNBOUNDED PRECEDING) AS para FROM k),
q AS (SELECT page, block, para, trim(string_agg(CASE WHEN b = 0 AND regexp_matches(coalesce(prev, ''), '[0-9A-Za-z]$') AND regexp_matches(text, '^[0-9A-Za-z]') THEN ' ' ELSE '' END || text, '' ORDER BY y0, line)) AS text FROM p GROUP BY 1, 2, 3),
t AS (SELECT page, block, string_agg(text, chr(10) ORDER BY para) AS text FROM q WHERE text <> '' GROUP BY 1, 2),
o AS (SELECT page, y0, x0, y1, x1, row_number() OVER (PARTITION BY page ORDER BY y0, x0, y1, x1) AS i FROM r WHERE NOT picture AND x1 - x0 >= 12 AND y1 - y0 >= 12 AND NOT ((x1 - x0) / greatest(y1 - y0, 1) > 6 AND y1 - y0 < 45)),
f AS (
  SELECT page, i, CAST(0 AS BIGINT) AS n, y0, x0, y1, x1 FROM o WHERE i = 1
  UNION ALL SELECT o.page, o.i, CASE WHEN near THEN n ELSE n + 1 END, CASE WHEN near THEN least(fy0, o.y0) ELSE o.y0 END, CASE WHEN near THEN least(fx0, o.x0) ELSE o.x0 END, CASE WHEN near THEN greatest(fy1, o.y1) ELSE o.y1 END, CASE WHEN near THEN greatest(fx1, o.x1) ELSE o.x1 END
  FROM (SELECT f.n, f.y0 AS fy0, f.x0 AS fx0, f.y1 AS fy1, f.x1 AS fx1, o.*, o.y0 - f.y1 <= 6 AND o.x0 - f.x1 <= 40 AND f.x0 - o.x1 <= 40 AS near FROM f JOIN o ON o.page = f.page AND o.i = f.i + 1) o
),
m AS (SELECT page, n, y0, x0, y1, x1 FROM f QUALIFY row_number() OVER (PARTITION BY page, n ORDER BY i DESC) = 1),
v AS (SELECT * FROM m WHERE NOT ((x1 - x0) / greatest(y1 - y0, 1) > 6 AND y1 - y0 < 60) AND x1 - x0 >= 30 AND y1 - y0 >= 20
  AND NOT EXISTS (SELECT 1 FROM r i WHERE i.page = m.page AND i.picture AND i.x1 - i.x0 >= 40 AND greatest(0, least(m.x1, i.x1) - greatest(m.x0, i.x0)) * greatest(0, least(m.y1, i.y1) - greatest(m.y0, i.y0)) > CAST(0.6 AS DOUBLE) * ((m.x1 - m.x0) * (m.y1 - m.y0)))),
u AS (SELECT t.page, 0 AS source, CAST(t.block AS BIGINT) AS n, 't' AS kind, y0, text, CAST(NULL AS DOUBLE) AS width, CAST(NULL AS DOUBLE) AS height FROM t JOIN tops USING (page, block)
  UNION ALL SELECT page, 1, n, 'f', CAST(y0 AS DOUBLE), NULL, CAST(x1 - x0 AS DOUBLE), CAST(y1 - y0 AS DOUBLE) FROM r WHERE picture AND x1 - x0 >= 40
  UNION ALL SELECT page, 2, n, 'f', y0, NULL, x1 - x0, y1 - y0 FROM v)
SELECT page, row_number() OVER (PARTITION BY page ORDER BY round_even(y0, 0), kind <> 't', source, n) AS place, kind, y0, md5(text) AS text, width, height FROM u"""
)
def page_collector(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as lines of pages, order lines as pictures and drawings on them."""
    n = F.length("text")
    text = F.when(n % 4 == 0, F.concat(F.lit("题"), "text")).when(n % 4 == 1, F.left("text", F.lit(5))).when(n % 4 == 2, F.concat("text", F.lit("。"))).otherwise(F.concat("text", F.lit("文")))
    y0 = (F.col("idx") * 1.0 - F.when(n % 7 == 0, 0.875).otherwise(0.0)) * 18.0 + n % 9
    x0 = (n % 50 * 4).cast("double")
    page_lines = lines(spark, d).select(F.col("doc_id").alias("page"), F.floor(F.col("idx") / 6).alias("block"), F.col("idx").alias("line"), text.alias("text"), y0.alias("y0"), (y0 + 10).alias("y1"), x0.alias("x0"), (x0 + F.least(n, F.lit(120))).alias("x1"), F.lit(10.0).alias("size"))
    own = read(spark, d, "lineitem")
    left, top = F.col("l_quantity") * 8, F.col("l_linenumber") * 30.0 + F.floor(F.col("l_orderkey") / 1000) % 40 * 9
    boxes = own.select((F.col("l_orderkey") % _PAGES).alias("page"), (((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")).alias("n"), left.alias("x0"), top.alias("y0"), (left + F.col("l_partkey") % 90 + 5).alias("x1"), (top + F.col("l_suppkey") % 40 + 4).alias("y1"), (F.col("l_suppkey") % 2 == 0).alias("picture"))
    found = op.page_items(page_lines, boxes.where("picture").drop("picture"), boxes.where("NOT picture").drop("picture", "n"))
    return found.withColumn("text", F.md5("text"))


_ROUND = """, x{r} AS (SELECT *, CAST(sum(CASE WHEN br THEN 1 ELSE 0 END) OVER w AS BIGINT) AS run, CAST(sum(height) OVER w AS BIGINT) - height AS before FROM a{r} WINDOW w AS (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING)),
s{r} AS (SELECT doc_id, run, CAST(sum(height) AS BIGINT) AS total, min(before) AS since FROM x{r} GROUP BY 1, 2),
b{r} AS (SELECT doc_id, run, since, coalesce(CAST(sum((total + 739) // 740) OVER (PARTITION BY doc_id ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS base FROM s{r}),
p{r} AS (SELECT l.doc_id, l.idx, l.title, l.k, l.height, l.br, base + (before - since) // 740 AS page, (before - since) % 740 AS top FROM x{r} l JOIN b{r} b ON b.doc_id = l.doc_id AND b.run = l.run)"""
_NEXT = ", a{n} AS (SELECT doc_id, idx, title, k, height, br OR top * 2 > 740 AS br FROM p{r})"


@query(
    _LINES.replace(" RECURSIVE", "")
    + ", a0 AS (SELECT doc_id, idx, left(text, 2) AS title, row_number() OVER (PARTITION BY doc_id, left(text, 2) ORDER BY idx) - 1 AS k, CAST(ceil(length(text) / 60.0) * 18 + 30 AS BIGINT) AS height, FALSE AS br FROM lines)"
    + "".join(_ROUND.format(r=r) + (_NEXT.format(r=r, n=r + 1) if r < pagination.ROUNDS else "") for r in range(pagination.ROUNDS + 1))
    + f" SELECT doc_id, idx, title, k AS occurrence, height, page, top, br AS breaks FROM p{pagination.ROUNDS}"
)
def pagination_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Lines as sections with titles that repeat; those in a page's lower half begin the next page, in rounds."""
    rows = lines(spark, d).select("doc_id", "idx", F.left("text", F.lit(2)).alias("title"), (F.ceil(F.length("text") / 60) * 18 + 30).cast("long").alias("height"))
    return pagination.paginate_by_title(rows, "doc_id", "idx", 740)
