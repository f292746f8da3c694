"""Text and html queries over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.functions import text as fn
from lessonweave.operators.scans import places
from lessonweave.plans.common import collection
from lessonweave.sources.tables import read

QUERIES, SQL, query = collection()


_TITLE = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"


def _title(c="html"):
    return F.regexp_extract(c, "(?is)<title>(.*?)</title>", 1)


@query(r"""
SELECT page_id, CASE WHEN x = '' THEN 'unnamed' ELSE x END AS name FROM (
  SELECT page_id, substr(regexp_replace(regexp_replace(regexp_replace(coalesce(url, ''), '[\\/:*?"<>|\x00-\x1f]+', '_', 'g'), '[\s　]+', ' ', 'g'), '^ | $', '', 'g'), 1, 80) AS x FROM pages)
""")
def sanitize_names(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", fn.sanitize(F.col("url")).alias("name"))


@query("SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS plain FROM pages")
def strip_tags_pages(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", fn.strip_tags(F.col("html")).alias("plain"))


@query("SELECT page_id, " + _TITLE + " AS title, CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS n_paras FROM pages")
def page_title_paras(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", _title().alias("title"), F.size(F.regexp_extract_all("html", F.lit("<p>"), F.lit(0))).alias("n_paras"))


@query("SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages")
def html_escape(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", fn.escape_html(F.col("html")).alias("escaped"))


@query("""
WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS ref FROM pages), k AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS name FROM part)
SELECT page_id, ref, name IS NOT NULL AS found FROM r LEFT JOIN k ON name = lower(ref)
""")
def inline_image_refs(spark: SparkSession, d: str) -> DataFrame:
    refs = read(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("ref"))
    known = read(spark, d, "part").select(F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("name")).distinct()
    return refs.join(known, F.col("name") == F.lower("ref"), "left").select("page_id", "ref", F.col("name").isNotNull().alias("found"))


@query("""
WITH r AS (SELECT page_id, ref, row_number() OVER () AS ord FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS ref FROM pages)),
u AS (SELECT DISTINCT page_id, ref FROM r)
SELECT u.page_id, u.ref FROM u WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.page_id = u.page_id AND contains(regexp_extract(p.html, '(?is)<title>(.*?)</title>', 1), u.ref))
""")
def figure_dedup(spark: SparkSession, d: str) -> DataFrame:
    """References once each, without those that the page's title already holds; settled within a row."""
    refs = F.array_distinct(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1)))
    return read(spark, d, "pages").select("page_id", F.explode(F.filter(refs, lambda r: ~F.contains(_title(), r))).alias("ref"))


@query("SELECT page_id, regexp_replace(html, '<li><a href=\"/[^\"]*\">[^<]{1,4}</a></li>', '', 'g') AS html FROM pages")
def drop_captions(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", F.regexp_replace("html", '<li><a href="/[^"]*">[^<]{1,4}</a></li>', "").alias("html"))


@query(r"SELECT page_id, regexp_replace(html, '(?s)^(.*)</style>', '\1.q{break-inside:avoid}</style>') AS html FROM pages")
def css_inject_last(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", fn.inject_css(F.col("html"), ".q{break-inside:avoid}").alias("html"))


@query("SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS INTEGER) AS idx FROM documents WHERE text IS NOT NULL")
def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "line"))


@query("""
SELECT doc_id, CASE WHEN contains(text, '<') THEN text ELSE replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '<br>') END AS html FROM documents
""")
def newline_to_br(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", fn.line_breaks(F.col("text")).alias("html"))


@query(r"""
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 3 = 0 THEN 'x' || l_partkey ELSE '\f(\f(' || l_partkey || ',2),' || l_suppkey || ')+\f(U,L)' END AS f FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, f, CASE WHEN t <> f THEN t END AS tex FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(f, '\\f\(([^(),]*),([^(),]*)\)', '\\frac{\1}{\2}', 'g'),
  '\\f\(([^(),]*),([^(),]*)\)', '\\frac{\1}{\2}', 'g'), '\\f\(([^(),]*),([^(),]*)\)', '\\frac{\1}{\2}', 'g'), '\\f\(([^(),]*),([^(),]*)\)', '\\frac{\1}{\2}', 'g') AS t FROM f)
""")
def eq_field_to_latex(spark: SparkSession, d: str) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    f = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("x"), s("l_partkey"))).otherwise(F.concat(F.lit("\\f(\\f("), s("l_partkey"), F.lit(",2),"), s("l_suppkey"), F.lit(")+\\f(U,L)")))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", f.alias("f")).withColumn("tex", fn.field_to_latex(F.col("f")))


@query(r"""
WITH t AS (SELECT o_orderkey, '\left( {\rm{ m }} \leqslant \dfrac{' || o_custkey || '}{2} \right) \, x' AS tex FROM orders)
SELECT o_orderkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(tex, '\\(?:rm|mathrm|text)\s*', '', 'g'), '\\left\s*', '', 'g'), '\\right\s*', '', 'g'),
  '\\dfrac', '\\frac', 'g'), '\\leqslant', '\\le', 'g'), '\\geqslant', '\\ge', 'g'), '\\(?:,|;|!|quad)', ' ', 'g'), '\s+', ' ', 'g')) AS tex FROM t
""")
def latex_cleanup(spark: SparkSession, d: str) -> DataFrame:
    tex = F.concat(F.lit(r"\left( {\rm{ m }} \leqslant \dfrac{"), F.col("o_custkey").cast("string"), F.lit(r"}{2} \right) \, x"))
    return read(spark, d, "orders").select("o_orderkey", fn.clean_latex(tex).alias("tex"))


@query("""
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'SymbolMT' ELSE 'Arial' END AS font, chr(CAST([61483, 61500, 61501, 61508, 61527, 61537, 61538, 61541, 61542, 61543, 61546, 61548, 61549, 61552, 61553, 61603, 61608, 61612, 61614, 61616, 61617, 61619, 61620, 61624, 61555][p_partkey % 25 + 1] AS INTEGER)) || p_name || chr(61620) AS text FROM part)
SELECT p_partkey, CASE WHEN contains(lower(font), 'symbol') THEN translate(text, list_aggregate(list_transform([61483, 61500, 61501, 61508, 61527, 61537, 61538, 61541, 61542, 61543, 61546, 61548, 61549, 61552, 61553, 61603, 61608, 61612, 61614, 61616, 61617, 61619, 61620, 61624], lambda c: chr(CAST(c AS INTEGER))), 'string_agg', ''), '+<=ΔΩαβεφγφλμπθ≤♦←→°±≥×÷') ELSE text END AS text FROM t
""")
def symbol_map(spark: SparkSession, d: str) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in [*fn.SYMBOLS, "\uf073"]])
    text = F.concat(F.element_at(codes, (F.col("p_partkey") % 25 + 1).cast("int")), F.col("p_name"), F.lit("\uf0b4"))
    font = F.when(F.col("p_partkey") % 2 == 0, "SymbolMT").otherwise("Arial")
    return read(spark, d, "part").select("p_partkey", fn.map_symbols(text, font).alias("text"))


@query("""
SELECT p_partkey, chr(CAST(65 + p_partkey % 26 AS INTEGER)) || chr(CAST(97 + p_partkey % 26 AS INTEGER)) || (p_partkey % 10) || chr(CAST(945 + p_partkey % 25 AS INTEGER)) || chr(CAST(913 + p_partkey % 17 AS INTEGER)) || p_name AS text FROM part
""")
def math_alnum_fold(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    pick = lambda chars, n: F.element_at(F.array(*[F.lit(c) for c in chars]), (k % n + 1).cast("int"))
    latin = [pick([chr(0x1D434 + i) for i in range(26)], 26), pick([chr(0x1D41A + i) for i in range(26)], 26), pick([chr(0x1D7D8 + i) for i in range(10)], 10)]
    greek = [pick([chr(0x1D6FC + i) for i in range(25)], 25), pick([chr(0x1D6A8 + i) for i in range(17)], 17)]
    return read(spark, d, "part").select("p_partkey", fn.fold_math(F.concat(*latin, *greek, F.col("p_name"))).alias("text"))


_SRT = """
WITH s AS (SELECT conv_id, turn, CAST(turn * 3.25 + conv_id % 7 / 16.0 AS DOUBLE) AS a, regexp_replace(text, '\\s+', ' ', 'g') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations WHERE trim(text) <> ''),
t AS (SELECT *, CAST(round_even(a * 1000, 0) AS BIGINT) AS x, CAST(round_even((a + 3) * 1000, 0) AS BIGINT) AS y FROM s)
SELECT conv_id, string_agg(n || chr(10) || printf('%02d:%02d:%02d,%03d', x // 3600000, x // 60000 % 60, x // 1000 % 60, x % 1000) || ' --> ' || printf('%02d:%02d:%02d,%03d', y // 3600000, y // 60000 % 60, y // 1000 % 60, y % 1000) || chr(10) || text, chr(10) || chr(10) ORDER BY n) AS srt
FROM t GROUP BY conv_id
""".replace("\\\\", "\\")


@query(_SRT)
def srt_format(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "conversations").where(F.trim("text") != "").select("conv_id", "turn", (F.col("turn") * 3.25 + F.col("conv_id") % 7 / 16.0).alias("a"), F.regexp_replace("text", r"\s+", " ").alias("text"))
    rows = places(rows, ["conv_id"], "turn", "n")
    block = F.concat(F.col("n").cast("string"), F.lit("\n"), fn.timestamp_srt(F.col("a")), F.lit(" --> "), fn.timestamp_srt(F.col("a") + 3), F.lit("\n"), "text")
    blocks = F.array_sort(F.collect_list(F.struct("n", block.alias("b"))))
    return rows.groupBy("conv_id").agg(F.array_join(F.transform(blocks, lambda x: x["b"]), "\n\n").alias("srt"))


@query("""
WITH l AS (SELECT l_orderkey AS playlist, l_linenumber * 10000000000 + l_partkey * 10000 + l_suppkey AS ord, CASE WHEN l_linenumber = 1 THEN '#EXT-X-KEY:METHOD=AES,URI="k/' || l_partkey || '"' WHEN l_linenumber = 4 THEN '#EXTINF:9' WHEN l_linenumber = 6 THEN '' ELSE 'seg' || l_partkey || '.ts' END AS line FROM lineitem)
SELECT playlist, line AS segment, row_number() OVER (PARTITION BY playlist ORDER BY ord, line) AS n, max(CASE WHEN line LIKE '#EXT-X-KEY%' THEN regexp_extract(line, 'URI="([^"]+)"', 1) END) OVER (PARTITION BY playlist) AS key
FROM l QUALIFY line <> '' AND line NOT LIKE '#%'
""".replace("row_number() OVER (PARTITION BY playlist ORDER BY ord, line)", "count(*) FILTER (line <> '' AND line NOT LIKE '#%') OVER (PARTITION BY playlist ORDER BY ord, line ROWS UNBOUNDED PRECEDING)").replace("l_linenumber * 10000000000", "CAST(l_linenumber AS BIGINT) * 10000000000"))
def playlist_parse(spark: SparkSession, d: str) -> DataFrame:
    """Playlists as one text each, split again: comments go, segments keep their order, the key is kept."""
    ln, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    line = F.when(ln == 1, F.concat(F.lit('#EXT-X-KEY:METHOD=AES,URI="k/'), part, F.lit('"'))).when(ln == 4, "#EXTINF:9").when(ln == 6, "").otherwise(F.concat(F.lit("seg"), part, F.lit(".ts")))
    ord_ = ln.cast("long") * 10_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey")
    texts = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("playlist")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(ord_.alias("o"), line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
    lines = F.split("text", "\n")
    keys = F.filter(F.transform(lines, lambda x: F.regexp_extract(x, '^#EXT-X-KEY.*URI="([^"]+)"', 1)), lambda k: k != "")
    segments = F.filter(lines, lambda x: (x != "") & ~x.startswith("#"))
    return texts.select("playlist", F.array_max(keys).alias("key"), F.posexplode(segments).alias("n", "segment")).withColumn("n", (F.col("n") + 1).cast("long"))


@query("SELECT doc_id, CASE WHEN length(text) <= 130 THEN 3 WHEN length(text) <= 230 THEN 4 ELSE 6 END AS n_lines FROM documents")
def answer_space_lines(spark: SparkSession, d: str) -> DataFrame:
    from lessonweave.operators.answers import answer_lines

    return read(spark, d, "documents").select("doc_id", answer_lines(F.length("text")).alias("n_lines"))


@query("""
WITH t AS (SELECT p_partkey, p_partkey || '.' || p_name || ' · ' || p_brand || '（第' || (p_size % 3) || '课时）/' || p_type AS t FROM part)
SELECT p_partkey, regexp_replace(translate(t, '/（）', '_()'), '[\\s　]+', '', 'g') AS file, regexp_extract(t, '（([^）]*课时)）', 1) AS period, regexp_replace(t, '^[^.]*\\.', '') AS rest, regexp_replace(split_part(t, '·', 1), '^[\\s　]+|[\\s　]+$', '', 'g') AS tag FROM t
""".replace("\\\\", "\\"))
def title_parts(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.col("p_partkey").cast("string"), F.lit("."), "p_name", F.lit(" · "), "p_brand", F.lit("（第"), (F.col("p_size") % 3).cast("string"), F.lit("课时）/"), "p_type")
    return read(spark, d, "part").select("p_partkey", fn.title_to_file(t).alias("file"), fn.period_of(t).alias("period"), fn.after_first_dot(t).alias("rest"), fn.before_middle_dot(t).alias("tag"))


@query(r"""
SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, split_part(url, '?', 1) AS bare, regexp_extract(split_part(url, '?', 1), '([^/]*)/?$', 1) AS base, substr(md5(url), 1, 16) AS short_id, 'data:text/plain;base64,' || base64(encode(url)) AS uri FROM pages
""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    bare = F.split_part("url", F.lit("?"), F.lit(1))
    coded = F.replace(F.base64(F.col("url").cast("binary")), F.lit("\r\n"), F.lit(""))  # Spark breaks lines after 76 characters
    return read(spark, d, "pages").select(
        "page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), bare.alias("bare"), F.regexp_extract(bare, "([^/]*)/?$", 1).alias("base"), F.substring(F.md5("url"), 1, 16).alias("short_id"), F.concat(F.lit("data:text/plain;base64,"), coded).alias("uri")
    )


@query("""
SELECT n_regionkey, '<table><tr><th>key</th><th>name</th></tr>' || string_agg('<tr><td>' || n_nationkey || '</td><td>' || n_name || '</td></tr>', '' ORDER BY n_nationkey) || '</table>' AS html FROM nation GROUP BY 1
""")
def table_to_html(spark: SparkSession, d: str) -> DataFrame:
    rows = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda r: F.array(r["n_nationkey"].cast("string"), r["n_name"]))
    grouped = read(spark, d, "nation").groupBy("n_regionkey").agg(rows.alias("rows"))
    return grouped.select("n_regionkey", fn.table_html(F.concat(F.array(F.array(F.lit("key"), F.lit("name"))), "rows")).alias("html"))


@query("""
SELECT p_partkey, '<sup>' || p_size || p_brand || '</sup><sub>' || p_name || '</sub><sup>x</sup>' AS html FROM part
""")
def run_coalesce(spark: SparkSession, d: str) -> DataFrame:
    html = F.concat(F.lit("<sup>"), F.col("p_size").cast("string"), F.lit("</sup><sup>"), "p_brand", F.lit("</sup><sub>"), "p_name", F.lit("</sub><sup>x</sup>"))
    return read(spark, d, "part").select("p_partkey", fn.coalesce_runs(html).alias("html"))


@query(r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), l AS (SELECT doc_id, unnest(ls) AS l, unnest(generate_series(1, len(ls))) AS i FROM d),
b AS (SELECT doc_id, min(i) AS first FROM l WHERE length(l) >= 60 GROUP BY 1)
SELECT doc_id, CAST(count(*) AS BIGINT) AS kept FROM l JOIN b USING (doc_id) WHERE i >= first GROUP BY 1
""")
def header_skip(spark: SparkSession, d: str) -> DataFrame:
    """Lines from the first long one on; a document without any has no body. Settled within a row."""
    lines = F.split("text", "\n")
    first = F.array_min(F.transform(F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), (F.length(x) >= 60).alias("long"))), lambda s: s["long"]), lambda s: s["i"]))
    return read(spark, d, "documents").select("doc_id", (F.size(lines) - first).cast("long").alias("kept")).where("kept IS NOT NULL")
