"""Question and answer queries over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.operators import answers as op
from lessonweave.operators.catalog_build import lesson_lists
from lessonweave.operators.scans import places
from lessonweave.plans.common import collection
from lessonweave.sources.tables import read

QUERIES, SQL, query = collection()


_PAIRS_SQL = """
WITH n AS (
  SELECT conv_id AS doc, turn, role, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS r,
    sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS total
  FROM conversations WHERE role IN ('user', 'assistant')
), pairs AS (
  SELECT doc, CAST(greatest(r, 1) AS BIGINT) AS no,
    coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'user'), '') AS question, coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'assistant'), '') AS answer
  FROM n WHERE total > 0 GROUP BY 1, 2
)
"""
_ASK = "SELECT doc, no, 0 AS sub, no || '．' || question AS line FROM pairs"
_TELL = "SELECT doc, no, 1 AS sub, '【答案】' || answer AS line FROM pairs WHERE answer <> ''"
_ROOM = "SELECT doc, no, 1 AS sub, repeat('_', CASE WHEN length(question) <= 130 THEN 3 WHEN length(question) <= 230 THEN 4 ELSE 6 END) AS line FROM pairs"


def qa_pairs(spark: SparkSession, d: str) -> DataFrame:
    turns = read(spark, d, "conversations").where(F.col("role").isin("user", "assistant")).select(F.col("conv_id").alias("doc"), "turn", "role", "text")
    numbered = op.number_questions(turns, "doc", "turn", F.col("role") == "user").where("no IS NOT NULL")
    only = lambda role: F.when(F.col("role") == role, F.col("text"))
    part = lambda role: F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("turn", only(role).alias("t")))), lambda x: x["t"].isNotNull()), lambda x: x["t"]), " ")
    return numbered.groupBy("doc", "no").agg(part("user").alias("question"), part("assistant").alias("answer"))


@query(_PAIRS_SQL + _ASK + " UNION ALL " + _TELL)
def qa_booklet_teacher(spark: SparkSession, d: str) -> DataFrame:
    return op.edition_rows(qa_pairs(spark, d), "teacher")


@query(_PAIRS_SQL + _ASK + " UNION ALL " + _ROOM)
def qa_booklet_student(spark: SparkSession, d: str) -> DataFrame:
    return op.edition_rows(qa_pairs(spark, d), "student")


@query(_PAIRS_SQL + _TELL)
def qa_answer_key(spark: SparkSession, d: str) -> DataFrame:
    return op.edition_rows(qa_pairs(spark, d), "answer")


@query(_PAIRS_SQL + ", e AS (" + _ASK + " UNION ALL " + _TELL + ") SELECT doc, string_agg(line, chr(10) ORDER BY no, sub) AS page FROM e GROUP BY doc")
def qa_booklet_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = op.edition_rows(qa_pairs(spark, d), "teacher")
    return rows.groupBy("doc").agg(op.joined_text(F.col("line"), F.struct("no", "sub"), "\n").alias("page"))


@query("""
SELECT conv_id, turn FROM conversations u WHERE role = 'user'
  AND NOT EXISTS (SELECT 1 FROM conversations a WHERE a.conv_id = u.conv_id AND a.role = 'assistant' AND a.turn > u.turn)
""")
def unanswered_questions(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "conversations").select("conv_id", "turn", "role")
    last = c.where("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("last"))
    return c.where("role = 'user'").join(last, "conv_id", "left").where("last IS NULL OR last < turn").select("conv_id", "turn")


@query("""
WITH r AS (SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN event_id END AS no FROM events)
SELECT user_id, event_id, coalesce(
  last_value(no IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(no IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS owner
FROM r
""")
def pending_head_attach(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("no"))
    return op.attach_to_number(rows, "user_id", "event_id", "no").select("user_id", "event_id", "owner")


@query("""
WITH q AS (SELECT o_custkey AS doc, o_orderkey AS q, CAST(o_orderkey % 4 AS INTEGER) AS no, CAST(o_orderkey % 3 AS INTEGER) AS grp FROM orders),
a AS (SELECT l_suppkey AS doc, CAST(l_partkey % 4 AS INTEGER) AS no, CAST(l_partkey % 2 AS INTEGER) AS grp, CASE WHEN l_linenumber = 3 THEN ' ' ELSE l_returnflag || l_partkey END AS body FROM lineitem),
x AS (SELECT doc, no, grp, min(body) AS body FROM a WHERE trim(body) <> '' GROUP BY 1, 2, 3)
SELECT q.doc, q.no, q.grp, q.q, coalesce(e.body, p.body) AS body
FROM q LEFT JOIN x e ON e.doc = q.doc AND e.no = q.no AND e.grp = q.grp LEFT JOIN x p ON p.doc = q.doc AND p.no = q.no AND p.grp = 0
""")
def double_key_coalesce(spark: SparkSession, d: str) -> DataFrame:
    q = read(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("q"), (F.col("o_orderkey") % 4).cast("int").alias("no"), (F.col("o_orderkey") % 3).cast("int").alias("grp"))
    body = F.when(F.col("l_linenumber") == 3, " ").otherwise(F.concat("l_returnflag", F.col("l_partkey").cast("string")))
    a = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc"), (F.col("l_partkey") % 4).cast("int").alias("no"), (F.col("l_partkey") % 2).cast("int").alias("grp"), body.alias("body"))
    return op.double_lookup(q, a)


@query("""
WITH r AS (SELECT o_custkey AS doc, o_orderkey AS q, CAST(o_orderkey % 6 AS INTEGER) AS no, CAST(o_orderkey % 2 AS INTEGER) AS grp FROM orders),
m AS (SELECT c_custkey AS doc, CAST(c_custkey % 6 AS INTEGER) AS no, CAST(c_nationkey % 2 AS INTEGER) AS grp, CAST(c_custkey % 6 + 10 AS INTEGER) AS new_no FROM customer WHERE c_acctbal < 2000)
SELECT r.doc, coalesce(new_no, r.no) AS no, r.grp, q FROM r LEFT JOIN m ON m.doc = r.doc AND m.no = r.no AND m.grp = r.grp
""")
def remap_then_join(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("q"), (F.col("o_orderkey") % 6).cast("int").alias("no"), (F.col("o_orderkey") % 2).cast("int").alias("grp"))
    remap = read(spark, d, "customer").where("c_acctbal < 2000").select(F.col("c_custkey").alias("doc"), (F.col("c_custkey") % 6).cast("int").alias("no"), (F.col("c_nationkey") % 2).cast("int").alias("grp"), (F.col("c_custkey") % 6 + 10).cast("int").alias("new_no"))
    return op.remap_numbers(rows, remap)


@query("""
WITH t AS (SELECT o_orderkey AS task, o_custkey % 25 AS lesson, o_orderpriority AS title, lower(o_orderstatus || o_orderkey) AS body FROM orders),
lib AS (SELECT c_nationkey AS lesson, CASE WHEN c_custkey % 3 = 0 THEN m ELSE m || '·' || CASE WHEN c_custkey % 5 = 0 THEN 'example ' ELSE '' END || c_custkey END AS entry, c_custkey AS ord, c_name AS answer
  FROM (SELECT *, ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][CAST(c_custkey % 5 + 1 AS INTEGER)] AS m FROM customer)),
cue AS (SELECT DISTINCT entry, substr(entry, length(entry), 1) AS cue FROM lib WHERE contains(entry, '·')),
h AS (SELECT task, CASE WHEN contains(body, cue) THEN 0 WHEN contains(lib.entry, 'example') THEN 1 ELSE 2 END AS r, ord, answer
  FROM t JOIN lib USING (lesson) LEFT JOIN cue ON cue.entry = lib.entry WHERE lib.entry = title OR starts_with(lib.entry, title || '·')),
b AS (SELECT task, answer FROM h QUALIFY row_number() OVER (PARTITION BY task ORDER BY r, ord, answer) = 1)
SELECT t.task, lesson, title, answer FROM t LEFT JOIN b USING (task)
""")
def answer_library_match(spark: SparkSession, d: str) -> DataFrame:
    tasks = read(spark, d, "orders").select(F.col("o_orderkey").alias("task"), (F.col("o_custkey") % 25).cast("int").alias("lesson"), F.col("o_orderpriority").alias("title"), F.lower(F.concat("o_orderstatus", F.col("o_orderkey").cast("string"))).alias("body"))
    names = F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    m = F.element_at(names, (F.col("c_custkey") % 5 + 1).cast("int"))
    extra = F.concat(m, F.lit("·"), F.when(F.col("c_custkey") % 5 == 0, "example ").otherwise(""), F.col("c_custkey").cast("string"))
    library = read(spark, d, "customer").select(F.col("c_nationkey").alias("lesson"), F.when(F.col("c_custkey") % 3 == 0, m).otherwise(extra).alias("entry"), F.col("c_custkey").alias("ord"), F.col("c_name").alias("answer"))
    cues = library.where(F.contains("entry", F.lit("·"))).select("entry", F.right("entry", F.lit(1)).alias("cue")).distinct()
    return op.match_library(tasks, library, cues)


@query("""
WITH a AS (SELECT doc_id, quality AS v, 'own' AS src FROM labels WHERE doc_id % 2 = 0), b AS (SELECT doc_id, toxic AS v, 'library' AS src FROM labels WHERE doc_id % 3 <> 1)
SELECT d.doc_id, coalesce(a.v, b.v, -1) AS v, coalesce(a.src, b.src, 'none') AS src FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN b ON b.doc_id = d.doc_id
""")
def lookup_coalesce(spark: SparkSession, d: str) -> DataFrame:
    labels = read(spark, d, "labels")
    own = labels.where("doc_id % 2 = 0").select("doc_id", F.col("quality").alias("own"))
    library = labels.where("doc_id % 3 <> 1").select("doc_id", F.col("toxic").alias("library"))
    both = own.join(library, "doc_id", "full")
    src = F.when(F.col("own").isNotNull(), "own").when(F.col("library").isNotNull(), "library").otherwise("none")
    return read(spark, d, "documents").select("doc_id").join(both, "doc_id", "left").select("doc_id", F.coalesce("own", "library", F.lit(-1)).alias("v"), src.alias("src"))


@query("""
SELECT conv_id AS doc, turn, role AS kind, text FROM conversations
UNION ALL SELECT doc_id, CAST(-1 AS BIGINT), 'ans', 'quality ' || quality FROM labels
""")
def inject_union(spark: SparkSession, d: str) -> DataFrame:
    sections = read(spark, d, "conversations").select(F.col("conv_id").alias("doc"), "turn", F.col("role").alias("kind"), "text")
    extra = read(spark, d, "labels").select(F.col("doc_id").alias("doc"), F.lit("ans").alias("kind"), F.concat(F.lit("quality "), F.col("quality")).alias("text"))
    return sections.unionByName(extra, allowMissingColumns=True).withColumn("turn", F.coalesce("turn", F.lit(-1)))


@query("""
WITH u AS (SELECT o_custkey AS k, o_orderkey AS v, o_orderstatus AS s, 0 AS src FROM orders WHERE o_orderkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1
UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, 1 FROM orders WHERE o_orderkey % 2 = 1 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
SELECT k, v, s FROM u QUALIFY row_number() OVER (PARTITION BY k ORDER BY src DESC) = 1
""")
def merge_sources_upsert(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    part = lambda rows: rows.groupBy(F.col("o_custkey").alias("k")).agg(F.min_by(F.struct(F.col("o_orderkey").alias("v"), F.col("o_orderstatus").alias("s")), "o_orderkey").alias("x")).select("k", "x.*")
    return op.upsert(part(o.where("o_orderkey % 2 = 0")), part(o.where("o_orderkey % 2 = 1")), ["k"])


@query("""
WITH t AS (SELECT l_orderkey AS doc, l_linenumber AS no, CASE WHEN l_returnflag = 'R' THEN '解析' ELSE '答案' END AS tag, l_partkey AS ord FROM lineitem)
SELECT doc, no, CASE WHEN bool_or(tag = '解析') THEN '解析' ELSE min_by(tag, ord) END AS tag, count(*) AS n FROM t GROUP BY 1, 2
""")
def tag_override(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("no"), F.when(F.col("l_returnflag") == "R", "解析").otherwise("答案").alias("tag"), F.col("l_partkey").alias("ord"))
    return t.groupBy("doc", "no").agg(F.when(F.bool_or(F.col("tag") == "解析"), "解析").otherwise(F.min_by("tag", "ord")).alias("tag"), F.count(F.lit(1)).alias("n"))


@query("""
WITH s AS (SELECT DISTINCT l_suppkey AS doc, CASE WHEN l_quantity < 5 THEN 'few ' || l_partkey WHEN l_discount > 0.08 THEN 'cheap' END AS w FROM lineitem),
p AS (SELECT doc, w, row_number() OVER (PARTITION BY doc ORDER BY w) AS place FROM s WHERE w IS NOT NULL)
SELECT doc, (place - 1) // 20 AS part, count(*) AS n, string_agg(w, ',' ORDER BY w) AS listing FROM p GROUP BY 1, 2
""")
def warning_lists(spark: SparkSession, d: str) -> DataFrame:
    """Each document's different warnings in order, in rows of a bounded length: distinct before they are gathered, placed by ranges."""
    w = F.when(F.col("l_quantity") < 5, F.concat(F.lit("few "), F.col("l_partkey").cast("string"))).when(F.col("l_discount") > 0.08, "cheap")
    found = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc"), w.alias("w")).where("w IS NOT NULL").distinct()
    # Ranges are cut by a number that sorts as the texts do: their first seven characters, which are ASCII.
    number = F.conv(F.rpad(F.hex(F.left("w", F.lit(7))), 14, "0"), 16, 10).cast("long")
    return lesson_lists(found.withColumn("first", number), ["doc"], "w", ["first", "w"], 20)


@query("""
WITH r AS (SELECT 'app' AS kind, event_type AS media, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'fix', event_type, count(*) FROM events WHERE value > 50 GROUP BY 2)
SELECT kind, string_agg('| ' || media || ' | ' || n || ' |', chr(10) ORDER BY n DESC, media) AS report FROM r GROUP BY kind
""")
def formula_report(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("event_type", "value")
    count = lambda rows, kind: rows.groupBy(F.col("event_type").alias("media")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
    rows = count(e, "app").unionByName(count(e.where("value > 50"), "fix"))
    line = F.concat(F.lit("| "), "media", F.lit(" | "), F.col("n").cast("string"), F.lit(" |"))
    return rows.groupBy("kind").agg(op.joined_text(line, F.struct((-F.col("n")).alias("a"), F.col("media").alias("b")), "\n").alias("report"))


@query("""
SELECT conv_id AS doc, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS no, turn FROM conversations WHERE role = 'user' AND conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system')
""")
def labelled_questions(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "conversations").select("conv_id", "turn", "role")
    asked = c.where("role = 'user'").join(c.where("role = 'system'").select("conv_id"), "conv_id", "left_semi")
    return places(asked.select(F.col("conv_id").alias("doc"), "turn"), ["doc"], "turn", "no").select("doc", "no", "turn")
