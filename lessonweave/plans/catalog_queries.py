"""Catalog queries over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.checkpoints import shared_path
from lessonweave.operators import catalog as op
from lessonweave.operators import catalog_build as build
from lessonweave.operators.scans import places
from lessonweave.plans.common import collection
from lessonweave.sources.catalog import listing, write_sections
from lessonweave.sources.tables import read
from lessonweave.streaming.resume import run_new_files

QUERIES, SQL, query = collection()


@query("""
WITH t AS (SELECT 'R' || r_regionkey AS id, r_name AS title, r_regionkey + 1 AS ord FROM region)
SELECT id AS node_id, CAST(NULL AS VARCHAR) AS parent_id, ord, 0 AS depth, title, id AS node_path FROM t
UNION ALL
SELECT 'N' || n_nationkey, 'R' || n_regionkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER), 1, n_name, 'R' || n_regionkey || '/N' || n_nationkey FROM nation
UNION ALL
SELECT 'C' || c_custkey, 'N' || c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER), 2, c_name, 'R' || n_regionkey || '/N' || c_nationkey || '/C' || c_custkey
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def tree_flatten(spark: SparkSession, d: str) -> DataFrame:
    kid = F.struct(F.col("n_nationkey").alias("k"), F.concat(F.lit("N"), F.col("n_nationkey")).alias("id"), F.col("n_name").alias("title"))
    kids = read(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(kid)).alias("kids"))
    roots = read(spark, d, "region").join(kids, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    roots = roots.select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("id"), F.col("r_name").alias("title"), (F.col("r_regionkey") + 1).alias("ord"), "kids")
    top = op.flatten_tree(roots, "id", "title", "kids")
    leaves = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    leaves = places(leaves, ["c_nationkey"], "c_custkey", "place")
    leaves = leaves.select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("node_id"), F.concat(F.lit("N"), F.col("c_nationkey")).alias("parent_id"), F.col("place").cast("int").alias("ord"), F.lit(2).alias("depth"),
        F.col("c_name").alias("title"), F.concat(F.lit("R"), F.col("n_regionkey"), F.lit("/N"), F.col("c_nationkey"), F.lit("/C"), F.col("c_custkey")).alias("node_path"),
    )
    return top.unionByName(leaves)


@query("""
WITH c AS (
  SELECT c_custkey AS course_id, unnest(['R' || (c_custkey % 7) || '/N' || c_nationkey, 'R' || (c_nationkey % 5) || '/N' || (c_custkey % 30), 'R' || (c_custkey % 3)]) AS path, unnest([0, 1, 2]) AS pos FROM customer
), k AS (
  SELECT course_id, pos, split_part(path, '/', 1) AS chapter_id, nullif(split_part(path, '/', 2), '') AS node_id FROM c
), f AS (
  SELECT k.*, r_name AS chapter FROM k JOIN region ON chapter_id = 'R' || r_regionkey QUALIFY row_number() OVER (PARTITION BY course_id ORDER BY pos) = 1
)
SELECT course_id, chapter_id, chapter, node_id, n_name AS lesson FROM f LEFT JOIN nation ON node_id = 'N' || n_nationkey
""")
def course_first_path_join(spark: SparkSession, d: str) -> DataFrame:
    c, n = F.col("c_custkey"), F.col("c_nationkey")
    path = lambda head, tail: F.concat(F.lit("R"), head, F.lit("/N"), tail)
    courses = read(spark, d, "customer").select(c.alias("course_id"), F.array(path(c % 7, n), path(n % 5, c % 30), F.concat(F.lit("R"), c % 3)).alias("chapter_paths"))
    chapters = read(spark, d, "region").select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("chapter_id"), F.col("r_name").alias("chapter"))
    nodes = read(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("node_id"), F.col("n_name").alias("lesson"))
    return op.first_known_path(courses, chapters, nodes).select("course_id", "chapter_id", "chapter", "node_id", "lesson")


#: Order lines as items of a resource bundle: a flag, a format, storages.
_ITEMS_SQL = """
WITH items AS (
  SELECT l_orderkey AS bundle, CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 10000 + l_suppkey AS pos,
    ['folder', 'source', 'thumbnail_s', 'pdf', 'href', 'preview', 'file', 'ai_text', 'superboard'][CAST((l_partkey + l_linenumber) % 9 + 1 AS INTEGER)] AS flag,
    CASE WHEN l_suppkey % 3 = 0 THEN '' WHEN l_suppkey % 3 = 1 THEN 'mp4' ELSE 'm3u8' END AS format,
    CASE WHEN l_partkey % 5 = 0 THEN ['cs://' || l_partkey] WHEN l_partkey % 5 = 1 THEN ['cs://' || l_partkey, 'http://a.example/' || l_partkey || '.pdf?x=1.2'] ELSE ['http://b.example/' || l_partkey] END AS storages
  FROM lineitem
)
"""


def _pos():
    return F.col("l_linenumber").cast("long") * 10_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey")


def _items(spark: SparkSession, d: str) -> DataFrame:
    part = F.col("l_partkey").cast("string")
    flags = F.array(*[F.lit(x) for x in ("folder", "source", "thumbnail_s", "pdf", "href", "preview", "file", "ai_text", "superboard")])
    storages = (
        F.when(F.col("l_partkey") % 5 == 0, F.array(F.concat(F.lit("cs://"), part)))
        .when(F.col("l_partkey") % 5 == 1, F.array(F.concat(F.lit("cs://"), part), F.concat(F.lit("http://a.example/"), part, F.lit(".pdf?x=1.2"))))
        .otherwise(F.array(F.concat(F.lit("http://b.example/"), part)))
    )
    fmt = F.when(F.col("l_suppkey") % 3 == 0, "").when(F.col("l_suppkey") % 3 == 1, "mp4").otherwise("m3u8")
    return read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("bundle"), _pos().alias("pos"), F.element_at(flags, ((F.col("l_partkey") + F.col("l_linenumber")) % 9 + 1).cast("int")).alias("flag"), fmt.alias("format"), storages.alias("storages"), (F.col("l_suppkey") % 2).cast("int").alias("bundle_pos")
    )


@query(
    _ITEMS_SQL
    + """, ranked AS (
  SELECT *, CASE flag WHEN 'href' THEN 0 WHEN 'source' THEN 1 WHEN 'pdf' THEN 2 WHEN 'file' THEN 3 END AS r FROM items
), best AS (
  SELECT *, list_filter(storages, lambda s: starts_with(s, 'http'))[1] AS url FROM ranked WHERE r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY bundle ORDER BY r, pos) = 1
)
SELECT bundle, flag, url,
  CASE WHEN format <> '' THEN format WHEN url IS NULL THEN NULL WHEN regexp_matches(split_part(url, '?', 1), '\\.[A-Za-z0-9]{1,5}$') THEN regexp_extract(split_part(url, '?', 1), '\\.([A-Za-z0-9]{1,5})$', 1) ELSE 'bin' END AS ext
FROM best
""".replace("\\\\", "\\")
)
def priority_pick_item(spark: SparkSession, d: str) -> DataFrame:
    return op.pick_resource(_items(spark, d), "bundle", "pos")


@query("""
WITH v AS (
  SELECT l_orderkey AS resource, CAST(l_suppkey % 2 AS INTEGER) AS bundle_pos, CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 10000 + l_suppkey AS item_pos, 'http://v.example/' || l_partkey AS url,
    CASE WHEN l_partkey % 4 = 0 THEN 0 WHEN l_suppkey % 3 = 2 THEN 1 END AS r
  FROM lineitem
)
SELECT resource, bundle_pos, item_pos, url FROM v WHERE r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY resource ORDER BY bundle_pos, r, item_pos) = 1
""")
def video_pick_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    items = read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("resource"), (F.col("l_suppkey") % 2).cast("int").alias("bundle_pos"), _pos().alias("item_pos"),
        F.when(F.col("l_partkey") % 4 == 0, "720p").otherwise("360p").alias("flag"), F.when(F.col("l_suppkey") % 3 == 2, "m3u8").otherwise("mp4").alias("format"),
        F.concat(F.lit("http://v.example/"), F.col("l_partkey")).alias("url"),
    )
    return op.pick_video(items, "resource", "720p", "m3u8")


@query("""
WITH p AS (SELECT o_custkey AS course_id, o_orderkey AS resource, trim(split_part(o_orderpriority, '-', 2)) AS period FROM orders),
n AS (SELECT course_id, count(DISTINCT period) AS k FROM p GROUP BY 1)
SELECT p.course_id, resource, CASE WHEN k > 1 THEN period || '_' || resource ELSE CAST(resource AS VARCHAR) END AS file FROM p JOIN n USING (course_id)
""")
def multi_period_naming(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "orders").select(F.col("o_custkey").alias("course_id"), F.col("o_orderkey").alias("resource"), F.trim(F.split_part("o_orderpriority", F.lit("-"), F.lit(2))).alias("period"))
    several = p.groupBy("course_id").agg((F.min("period") != F.max("period")).alias("several"))
    name = F.when(F.col("several"), F.concat_ws("_", "period", "resource")).otherwise(F.col("resource").cast("string"))
    return p.join(several, "course_id").select("course_id", "resource", name.alias("file"))


@query("""
SELECT o_orderkey AS resource,
  CASE WHEN o_custkey % 11 = 0 THEN 'elite' WHEN o_orderstatus = 'P' THEN 'review_book' WHEN o_orderkey % 10 = 3 THEN 'review_' || (o_custkey % 6 + 1) ELSE (o_orderkey % 9) || '.' || lower(o_orderpriority) END AS folder
FROM orders
""")
def folder_route_case(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("o_custkey") % 11 == 0, "elite_lesson").otherwise("national_lesson")
    review = F.when(F.col("o_orderstatus") == "P", "book").when(F.col("o_orderkey") % 10 == 3, "chapter").otherwise("")
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("resource"), op.route_folder(kind, review, F.col("o_custkey") % 6, F.col("o_orderkey") % 9, F.lower("o_orderpriority")).alias("folder"))


@query("SELECT doc_id, lang, source, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def first_wins_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").withColumn("key", F.sha2("text", 256))
    return op.first_wins(docs.select("key", "doc_id", "lang", "source", "n_chars"), ["key"], ["doc_id"]).drop("key")


@query("""
SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY 1
""")
def last_wins_orders(spark: SparkSession, d: str) -> DataFrame:
    return op.last_wins(read(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query("""
SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS ok, count(*) FILTER (o_orderstatus = 'O') AS pending, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS failed, count(DISTINCT o_custkey) AS courses
FROM orders GROUP BY 1
""")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("o_orderstatus")
    return read(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(s == "F").alias("ok"), F.count_if(s == "O").alias("pending"), F.count_if(~s.isin("F", "O")).alias("failed"), F.countDistinct("o_custkey").alias("courses")
    )


@query("""
WITH l AS (
  SELECT n_regionkey, n_nationkey, n_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n,
    (SELECT string_agg(c_name, ';' ORDER BY c_custkey) FROM (SELECT * FROM customer WHERE c_nationkey = n_nationkey)) AS names
  FROM nation
)
SELECT r_name AS chapter, count(n_nationkey) AS lessons, CAST(sum(n) AS BIGINT) AS resources,
  string_agg(n_name || ':' || coalesce(names, ''), '|' ORDER BY n_nationkey) AS listing
FROM region LEFT JOIN l ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name
""")
def catalog_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Lessons and resources of each chapter, counted and listed."""
    chapters = read(spark, d, "region").select(F.col("r_regionkey").alias("chapter_id"), F.col("r_name").alias("chapter"))
    lessons = read(spark, d, "nation").select(F.col("n_regionkey").alias("chapter_id"), F.col("n_nationkey").alias("lesson_id"), F.col("n_name").alias("lesson"))
    resources = read(spark, d, "customer").select(F.col("c_nationkey").alias("lesson_id"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("name"))
    return build.chapter_rollup(chapters, lessons, resources)


@query("""
SELECT DISTINCT o_custkey % 25 AS lesson, o_custkey AS resource FROM orders
WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = o_custkey % 25 AND n_regionkey < 2)
""")
def extra_lessons_anti(spark: SparkSession, d: str) -> DataFrame:
    listed = read(spark, d, "nation").where("n_regionkey < 2").select(F.col("n_nationkey").cast("long").alias("lesson"))
    found = read(spark, d, "orders").select((F.col("o_custkey") % 25).alias("lesson"), F.col("o_custkey").alias("resource")).distinct()
    return found.join(listed, "lesson", "left_anti")


@query("""
SELECT o_custkey AS folder, o_orderpriority AS period,
  max_by(o_orderkey, o_orderkey) FILTER (o_orderstatus = 'F') AS task, max_by(o_orderkey, o_orderkey) FILTER (o_orderstatus = 'O') AS exercise
FROM orders GROUP BY 1, 2
""")
def pair_by_period(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "task").when(F.col("o_orderstatus") == "O", "exercise")
    files = read(spark, d, "orders").select(F.col("o_custkey").alias("folder"), F.col("o_orderpriority").alias("period"), kind.alias("kind"), F.col("o_orderkey").alias("file"), F.col("o_orderkey").alias("ord"))
    return op.pair_by_period(files, ["folder", "period"], ("task", "exercise"))


@query("""
WITH w AS (SELECT DISTINCT split_part(p_name, ' ', 1) || ' ' AS prefix FROM part UNION SELECT DISTINCT p_name FROM part UNION SELECT DISTINCT left(p_name, 1) FROM part),
h AS (
  SELECT prefix, p_name || '#' || p_partkey || p_type AS name, CASE WHEN contains(p_name || '#' || p_partkey || p_type, 'STEEL') THEN 0 WHEN contains(p_name || '#' || p_partkey || p_type, 'BRASS') THEN 1 END AS r
  FROM w JOIN part ON starts_with(p_name || '#' || p_partkey || p_type, prefix)
)
SELECT w.prefix, (SELECT name FROM h WHERE h.prefix = w.prefix AND r IS NOT NULL ORDER BY r, name LIMIT 1) AS name FROM w
""")
def prefix_lookup_fallback(spark: SparkSession, d: str) -> DataFrame:
    part = read(spark, d, "part")
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    wanted = part.select(F.explode(F.array(F.concat(first, F.lit(" ")), F.col("p_name"), F.left("p_name", F.lit(1)))).alias("prefix")).distinct()
    files = part.select(F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string"), "p_type").alias("name"))
    return op.prefix_lookup(wanted, files, ["STEEL", "BRASS"])


@query("""
SELECT o_orderkey AS job FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey GROUP BY l_orderkey HAVING sum(l_quantity) > 100)
""")
def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    done = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("job")).agg(F.sum("l_quantity").alias("bytes"))
    return op.resume(read(spark, d, "orders").select(F.col("o_orderkey").alias("job")), done, "job", 100)


@query("""
SELECT c_custkey, coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_name END), ''), nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END, ''), '') AS title,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'worksheet' WHEN 'BUILDING' THEN 'exercise' ELSE 'other' END AS label
FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
""")
def type_whitelist_titles(spark: SparkSession, d: str) -> DataFrame:
    title = op.first_of(F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_name")), F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")))
    labels = spark.createDataFrame([("AUTOMOBILE", "worksheet"), ("BUILDING", "exercise"), ("MACHINERY", "other")], "c_mktsegment string, label string")
    return read(spark, d, "customer").join(F.broadcast(labels), "c_mktsegment").select("c_custkey", title.alias("title"), "label")


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'https://x.example/national/' || o_custkey || '.json' WHEN o_orderpriority LIKE '2%' THEN 'https://x.example/elite/' || o_custkey || '.json' END AS endpoint FROM orders
""")
def endpoint_routing(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("o_orderpriority")
    url = F.when(p.startswith("1"), F.format_string("https://x.example/national/%s.json", "o_custkey")).when(p.startswith("2"), F.format_string("https://x.example/elite/%s.json", "o_custkey"))
    return read(spark, d, "orders").select("o_orderkey", url.alias("endpoint"))


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY coalesce(nullif(o_custkey % 5, 0), 99), coalesce(try_cast(regexp_extract(o_orderpriority, '^(\\d+)-', 1) AS INTEGER), 99), o_orderkey) AS place
FROM orders
""".replace("\\\\", "\\"))
def prefix_sort(spark: SparkSession, d: str) -> DataFrame:
    """Places in a total order without one task for all rows."""
    group = F.coalesce(F.nullif(F.col("o_custkey") % 5, F.lit(0)), F.lit(99))
    number = F.coalesce(F.regexp_extract("o_orderpriority", r"^(\d+)-", 1).try_cast("int"), F.lit(99))
    rows = read(spark, d, "orders").select("o_orderkey", group.alias("group"), number.alias("number"))
    return op.global_places(rows, ["group", "number"], "o_orderkey", "place").select("o_orderkey", "place")


@query(
    _ITEMS_SQL.replace("WITH items", "WITH items0", 1).replace("FROM lineitem", "FROM lineitem", 1)
    + """, ranked AS (
  SELECT *, CASE flag WHEN 'href' THEN 0 WHEN 'source' THEN 1 WHEN 'pdf' THEN 2 WHEN 'file' THEN 3 END AS r FROM items0
), best AS (
  SELECT *, list_filter(storages, lambda s: starts_with(s, 'http'))[1] AS url FROM ranked WHERE r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY bundle ORDER BY r, pos) = 1
), picked AS (
  SELECT bundle, url, CASE WHEN format <> '' THEN format WHEN regexp_matches(split_part(url, '?', 1), '\\.[A-Za-z0-9]{1,5}$') THEN regexp_extract(split_part(url, '?', 1), '\\.([A-Za-z0-9]{1,5})$', 1) ELSE 'bin' END AS ext FROM best WHERE url IS NOT NULL
), c AS (
  SELECT c_custkey AS course_id, unnest(['R' || (c_custkey % 7) || '/N' || c_nationkey, 'R' || (c_nationkey % 5) || '/N' || (c_custkey % 30), 'R' || (c_custkey % 3)]) AS path, unnest([0, 1, 2]) AS pos FROM customer
), k AS (SELECT course_id, pos, split_part(path, '/', 1) AS chapter_id, nullif(split_part(path, '/', 2), '') AS node_id FROM c),
f AS (SELECT k.*, r_name AS chapter FROM k JOIN region ON chapter_id = 'R' || r_regionkey QUALIFY row_number() OVER (PARTITION BY course_id ORDER BY pos) = 1),
h AS (SELECT course_id, chapter_id, chapter, CASE WHEN n_name IS NOT NULL THEN node_id END AS lesson_id, n_name AS lesson FROM f LEFT JOIN nation ON node_id = 'N' || n_nationkey),
b AS (SELECT o_orderkey AS bundle, o_custkey AS course_id, trim(split_part(o_orderpriority, '-', 2)) AS period, 'r' || (o_orderkey % 37) AS name FROM orders JOIN picked ON bundle = o_orderkey),
s AS (SELECT course_id, count(DISTINCT period) > 1 AS several FROM b GROUP BY 1),
n AS (SELECT chapter_id, chapter, lesson_id, lesson, b.bundle, period, CASE WHEN several THEN period || '-' ELSE '' END || name || '.' || ext AS file, url, ext FROM b JOIN s USING (course_id) JOIN h USING (course_id) JOIN picked USING (bundle)),
w AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY chapter_id, lesson_id, file ORDER BY bundle) = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY chapter_id, lesson_id ORDER BY bundle, file) AS place FROM w)
SELECT chapter_id, chapter, lesson_id, lesson, (place - 1) // 50 AS part, place, file, url, ext, period FROM p
""".replace("\\\\", "\\")
)
def catalog_build(spark: SparkSession, d: str) -> DataFrame:
    """The whole catalog, written as nested JSON by chapter and read again."""
    c, n = F.col("c_custkey"), F.col("c_nationkey")
    path = lambda head, tail: F.concat(F.lit("R"), head, F.lit("/N"), tail)
    courses = read(spark, d, "customer").select(c.alias("course_id"), F.array(path(c % 7, n), path(n % 5, c % 30), F.concat(F.lit("R"), c % 3)).alias("chapter_paths"))
    chapters = read(spark, d, "region").select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("chapter_id"), F.col("r_name").alias("chapter"))
    nodes = read(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("node_id"), F.col("n_name").alias("lesson"))
    bundles = read(spark, d, "orders").select(F.col("o_orderkey").alias("bundle"), F.col("o_custkey").alias("course_id"), F.trim(F.split_part("o_orderpriority", F.lit("-"), F.lit(2))).alias("period"), F.concat(F.lit("r"), F.col("o_orderkey") % 37).alias("name"))
    rows = build.catalog_rows(courses, chapters, nodes, bundles, _items(spark, d).drop("bundle_pos"))
    written = shared_path(spark, "catalog")
    build.write_catalog(rows, written, 50)
    return build.read_catalog(spark, written)


@query("""
SELECT o_orderkey AS id, o_custkey AS lesson, o_orderstatus AS status, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS batch FROM orders
""")
def resumed_stream(spark: SparkSession, d: str) -> DataFrame:
    """Files arrive in two parts; a stream that ran after the first takes only the second when it runs again."""
    rows = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("lesson"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0).alias("batch"))
    source, out, state = (shared_path(spark, name) for name in ("arrivals", "taken", "progress"))
    for batch in (0, 1):
        rows.where(F.col("batch") == batch).write.mode("append").json(source)
        run_new_files(spark, source, "id long, lesson long, status string, batch int", lambda x: x, out, state)
    return spark.read.schema(rows.schema).parquet(out)


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def listed_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections as JSON in a folder for each status, replaced by a second writing; the folders of the listing, and the rows that are read back from each."""
    path = shared_path(spark, "sections")
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for rows in (orders.where("o_orderkey % 2 = 0"), orders):
        write_sections(rows, path, "o_orderstatus")
    folder = F.regexp_extract("path", "o_orderstatus=([^/]+)", 1)
    files = listing(spark, path, "*.json").where("bytes > 0").select("path", folder.alias("status"))
    lines = spark.read.schema("o_orderkey long, o_orderstatus string").json(path)
    return lines.join(files.select("status").distinct(), lines["o_orderstatus"] == F.col("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
