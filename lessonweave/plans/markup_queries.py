"""Predicates on lines, marked-up spans, pages and closures over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.functions import text as fn
from lessonweave.operators import markup as op
from lessonweave.operators.scans import prefix_scan
from lessonweave.plans.common import collection
from lessonweave.sources.tables import read

QUERIES, SQL, query = collection()


_LINES = "WITH l0 AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), lines AS (SELECT doc_id, unnest(ls) AS text, CAST(unnest(generate_series(0, len(ls) - 1)) AS INTEGER) AS idx FROM l0)"


def lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "text"))


@query(
    _LINES
    + r""" SELECT doc_id, idx, CASE WHEN regexp_matches(text, '^[\s　]*$') THEN 'blank' WHEN contains(text, '!!') OR length(text) <= 2 THEN 'boilerplate' WHEN regexp_matches(text, '^[0-9０-９]{1,2}[.．、]') THEN 'question'
  WHEN regexp_matches(text, '^[A-H][.．、]') THEN 'option' WHEN regexp_matches(text, '^(Licensed under|Released under|This work)') THEN 'head' WHEN length(text) < 80 AND contains(text, '=') THEN 'equation' ELSE 'prose' END AS kind,
  regexp_matches(text, '[一-鿿]') AS cjk FROM lines"""
)
def line_classes(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d).select("doc_id", "idx", op.line_class(F.col("text"), heads=["This work", "Licensed under", "Released under"], boilerplate=["!!"]).alias("kind"), F.col("text").rlike("[一-鿿]").alias("cjk"))


@query(r"""
SELECT conv_id, turn, length(text) >= 4 AND (regexp_matches(text, '[?？]$') OR length(text) > 40) AND NOT regexp_matches(text, '^[A-H][.．]') AS needs_line,
  len(regexp_extract_all(text, '[|;]')) >= 2 AS has_options, length(text) < 90 AND regexp_matches(text, '^[^,]*=[^,]*$') AS equation FROM conversations
""")
def question_predicates(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return read(spark, d, "conversations").select("conv_id", "turn", op.needs_answer_line(t).alias("needs_line"), (F.size(F.regexp_extract_all(t, F.lit("[|;]"), F.lit(0))) >= 2).alias("has_options"), ((F.length(t) < 90) & t.rlike("^[^,]*=[^,]*$")).alias("equation"))


@query(
    _LINES
    + """ SELECT doc_id, idx, coalesce(lag(contains(text, '|')) OVER w, FALSE) AND NOT contains(text, '|') AS after_options FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY idx)"""
)
def lookbehind_body(spark: SparkSession, d: str) -> DataFrame:
    bar = F.contains("text", F.lit("|"))
    rows = prefix_scan(lines(spark, d), ["doc_id"], "idx", lags={"before": bar})
    return rows.select("doc_id", "idx", (F.coalesce("before", F.lit(False)) & ~bar).alias("after_options"))


@query(r"""
WITH t AS (SELECT l_orderkey, string_agg(l_linenumber || CASE l_returnflag WHEN 'R' THEN 'AB' WHEN 'A' THEN 'C' ELSE 'D' END, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey) AS t FROM lineitem GROUP BY 1),
p AS (SELECT l_orderkey, regexp_extract_all(t, '(\d+)([A-H]+)', 1) AS n, regexp_extract_all(t, '(\d+)([A-H]+)', 2) AS a FROM t)
SELECT l_orderkey, CAST(unnest(n) AS INTEGER) AS no, unnest(a) AS answer, CAST(unnest(generate_series(0, len(n) - 1)) AS INTEGER) AS pos FROM p WHERE len(n) >= 2
""")
def inline_pairs(spark: SparkSession, d: str) -> DataFrame:
    own = F.concat(F.col("l_linenumber").cast("string"), F.when(F.col("l_returnflag") == "R", "AB").when(F.col("l_returnflag") == "A", "C").otherwise("D"))
    texts = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", own.alias("t")))), lambda x: x["t"]), " ").alias("t"))
    return texts.select("l_orderkey", F.posexplode(op.answer_pairs(F.col("t"))).alias("pos", "p")).select("l_orderkey", "p.no", "p.answer", "pos")


@query("""
WITH s AS (SELECT l_orderkey AS line, (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 100000 + l_suppkey AS x, CAST(10 - l_tax * 40 AS DOUBLE) AS size, CAST(l_suppkey % 5 AS DOUBLE) AS dy, CAST(l_partkey AS VARCHAR) AS text FROM lineitem),
m AS (SELECT *, max(size) OVER (PARTITION BY line) AS big FROM s)
SELECT line, string_agg(CASE WHEN size / big >= 0.82 THEN text WHEN dy <= 1.6 THEN '<sub>' || text || '</sub>' ELSE '<sup>' || text || '</sup>' END, '' ORDER BY x) AS html FROM m GROUP BY 1
""")
def span_html(spark: SparkSession, d: str) -> DataFrame:
    x = (F.col("l_linenumber").cast("long") * 1_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")
    spans = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("line"), x.alias("x"), (10 - F.col("l_tax") * 40).alias("size"), (F.col("l_suppkey") % 5).cast("double").alias("dy"), F.col("l_partkey").cast("string").alias("text"))
    return op.spans_to_html(spans, "line")


@query("""
WITH RECURSIVE r AS (
  SELECT p_partkey AS k FROM part WHERE p_partkey % 200 = 1
  UNION SELECT p.p_partkey FROM r JOIN part p ON p.p_partkey IN (r.k * 2, r.k * 3 + 1)
)
SELECT k FROM r
""")
def closure_rounds(spark: SparkSession, d: str) -> DataFrame:
    keys = read(spark, d, "part").select(F.col("p_partkey").alias("k"))
    steps = keys.select(F.col("k").alias("a"), F.explode(F.array(F.col("k") * 2, F.col("k") * 3 + 1)).alias("b")).join(keys.withColumnRenamed("k", "b"), "b", "left_semi")
    return op.closure(keys.where("k % 200 = 1"), steps)


@query("""
WITH b AS (SELECT conv_id, string_agg('<div class="' || role || '">' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</div>', '' ORDER BY turn) AS body FROM conversations GROUP BY 1)
SELECT conv_id, '<html><head><title>Conversation ' || conv_id || '</title></head><body>' || body || '</body></html>' AS html FROM b
""")
def html_pages(spark: SparkSession, d: str) -> DataFrame:
    div = F.concat(F.lit('<div class="'), "role", F.lit('">'), fn.escape_html(F.col("text")), F.lit("</div>"))
    bodies = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", div.alias("t")))), lambda x: x["t"]), "").alias("body"))
    return bodies.select("conv_id", op.page(F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")), F.col("body")).alias("html"))


@query("""
WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity * 3 AS w, l_suppkey % 70 + 1 AS h FROM lineitem)
SELECT l_orderkey, count(*) FILTER (w >= 40 AND h >= 12 AND NOT (w / h > 6 AND h < 45)) AS kept, count(*) FILTER (w < 40) AS narrow, count(*) FILTER (w >= 40 AND (h < 12 OR (w / h > 6 AND h < 45))) AS decoration FROM r GROUP BY 1
""")
def decoration_filter(spark: SparkSession, d: str) -> DataFrame:
    r = read(spark, d, "lineitem").select("l_orderkey", (F.col("l_quantity") * 3).alias("w"), (F.col("l_suppkey") % 70 + 1).alias("h"))
    kind = op.graphic_kind(F.col("w"), F.col("h"))
    return r.groupBy("l_orderkey").agg(*[F.count_if(kind == k).alias(k) for k in ("kept", "narrow", "decoration")])


@query(r"""
SELECT p_partkey, regexp_replace(t, '^(<[^>]+>)*[A-H][.．、]\s*', '') AS body, coalesce(try_cast(regexp_extract(t, '^(\d+)[.．、]', 1) AS INTEGER), -1) AS no, '<div class="fig">' || t || '</div>' AS wrapped
FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'B. ' || p_name ELSE p_size || '．' || p_name END AS t FROM part)
""")
def mark_stripping(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("B. "), "p_name")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit("．"), "p_name"))
    return read(spark, d, "part").select("p_partkey", op.strip_option_mark(t).alias("body"), F.coalesce(F.regexp_extract(t, r"^(\d+)[.．、]", 1).try_cast("int"), F.lit(-1)).alias("no"), F.concat(F.lit('<div class="fig">'), t, F.lit("</div>")).alias("wrapped"))
