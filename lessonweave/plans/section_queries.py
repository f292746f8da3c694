"""Queries of the sectionizer over lines of documents and turns of conversations that are dressed as lesson blocks, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.checkpoints import durable
from lessonweave.operators import sectioning as op
from lessonweave.operators.editions import OPEN_TASK, edition
from lessonweave.plans.common import collection
from lessonweave.sources.tables import read

QUERIES, SQL, query = collection()

#: What a line is dressed as, by its length and place; ``*`` is the line.
SHAPES = [
    "课后练习", "1．如图*", "A．*", "B．*", "2．如图*", "答案1AB 2C 3D", "3．如图*", "(1)*", "【答案】", "1．18.4  2．0.900　3.BD", "解析：*", "*", "【学习任务一】*",
    "《甲》【学习目标】*", "【课堂探究】", "【小结】*", "4．如图*", "5答案 AC", "自我测评 1．如图*", "Ａ．*", "课后练习答案", "AD   2．B  3．AB", "参考答案：D", "１２、如图*",
    "姓名", "第一章", "", "学习目标：*", "*", "【自我测评】如图*", "（2）*", "6. 由*", "11.2 *",
]
_TABLES, _FIGURES = 11, 5


def _dressed(rows: DataFrame) -> DataFrame:
    """(doc, idx, text) as blocks."""
    k = F.pmod(F.length("text") * 7 + F.col("idx") * 3, F.lit(len(SHAPES))).cast("int")
    shape = F.element_at(F.array(*[F.lit(s) for s in SHAPES]), k + 1)
    kind = F.when(F.pmod(F.length("text") + F.col("idx"), F.lit(_TABLES)) == 0, "table").otherwise("p")
    figures = F.when(F.pmod(F.length("text"), F.lit(_FIGURES)) == 0, F.array(F.concat(F.lit("media/f"), F.col("idx").cast("string"), F.lit(".png")))).otherwise(F.array().cast("array<string>"))
    return rows.select("doc", "idx", kind.alias("kind"), F.replace(shape, F.lit("*"), F.col("text")).alias("text"), figures.alias("figures"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").where("text IS NOT NULL")
    return _dressed(docs.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("idx", "text")))


def _conversations(spark: SparkSession, d: str) -> DataFrame:
    return _dressed(read(spark, d, "conversations").where("text IS NOT NULL").select(F.col("conv_id").alias("doc"), F.col("turn").alias("idx"), "text"))


_DOCUMENTS = "SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS idx FROM documents WHERE text IS NOT NULL"
_CONVERSATIONS = "SELECT conv_id AS doc, text, turn AS idx FROM conversations WHERE text IS NOT NULL"

_SQL = r"""
WITH RECURSIVE raw AS (<BLOCKS>),
blocks AS (SELECT doc, idx, CASE WHEN (length(text) + idx) % 11 = 0 THEN 'table' ELSE 'p' END AS kind, length(text) % 5 = 0 AS figs,
  regexp_replace(replace((<SHAPES>)[CAST((length(text) * 7 + idx * 3) % <N> AS INTEGER) + 1], '*', text), '^[\s　]+|[\s　]+$', '', 'g') AS t FROM raw),
base AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY idx) AS r, kind = 'p' AS p, regexp_matches(t, '^[0-9０-９]{1,2}[\s　]*[.．、][\s　]*[^\s　]') AS isno,
  nullif(translate(regexp_extract(t, '^([A-DＡ-Ｄ])[\s　]*[.．、][\s　]*[^\s　]', 1), 'ＡＢＣＤ', 'ABCD'), '') AS opt,
  regexp_matches(t, '^[（(][\s　]*[1１][\s　]*[）)]') AS sub1, regexp_matches(t, '^[\[【][^】]{1,12}[\]】][\s　]*[0-9０-９]{1,2}[\s　]*[.．、]') AS bracket FROM blocks),
solid AS (SELECT doc, idx, lead(struct_pack(p := p, n := isno, o := opt, s := sub1, q := isno OR bracket), 1) OVER w AS n1, lead(struct_pack(p := p, n := isno, o := opt, s := sub1, q := isno OR bracket), 2) OVER w AS n2,
  lead(struct_pack(p := p, n := isno, o := opt, s := sub1, q := isno OR bracket), 3) OVER w AS n3, lead(struct_pack(p := p, n := isno, o := opt, s := sub1, q := isno OR bracket), 4) OVER w AS n4
  FROM base WHERE t <> '' OR NOT p WINDOW w AS (PARTITION BY doc ORDER BY idx)),
ahead AS (SELECT doc, idx, CASE WHEN n1.p THEN n1 END AS a1, CASE WHEN n1.p AND n2.p THEN n2 END AS a2, CASE WHEN n1.p AND n2.p AND n3.p THEN n3 END AS a3, CASE WHEN n1.p AND n2.p AND n3.p AND n4.p THEN n4 END AS a4 FROM solid),
very AS (SELECT *, coalesce(lead(p AND opt IS NOT NULL, 1) OVER w, FALSE) OR coalesce(lead(p AND opt IS NOT NULL, 2) OVER w, FALSE) AS soon FROM base WINDOW w AS (PARTITION BY doc ORDER BY idx)),
kinds AS (SELECT doc, bool_or(p AND regexp_matches(t, '^[\[【]?[\s　]*(<TITLES>)[\s　]*[\]】]?[\s　]*$')) AS titled, count(*) FILTER (p AND regexp_matches(t, '^【[\s　]*(答案|解析|详解|解答|点拨)[\s　]*】')) AS evidence,
  count(*) FILTER (p AND isno AND soon) AS asks, min(idx) FILTER (p AND regexp_matches(t, '^【[\s　]*(答案|解析|详解|解答|点拨)[\s　]*】')) AS answers, min(idx) FILTER (p AND starts_with(t, '课后练习')) AS headed FROM very GROUP BY doc),
forced AS (SELECT b.doc, max(b.idx) AS at FROM base b JOIN kinds k ON k.doc = b.doc WHERE b.p AND b.isno AND b.idx < k.answers AND (k.headed IS NULL OR k.headed >= k.answers) GROUP BY 1),
parts AS (SELECT b.*, nullif(regexp_extract(t, '^[\[【]?[\s　]*(<TITLES>)[\s　]*[\]】]?[\s　]*', 1), '') AS head, regexp_replace(t, '^[\[【]?[\s　]*(<TITLES>)[\s　]*[\]】]?[\s　]*', '') AS rest0,
  regexp_matches(t, '^(【[^】]*答案[^】]*】|参考答案|答案)') AS ahead_, regexp_replace(regexp_replace(t, '^(【[^】]*答案[^】]*】|参考答案|答案)[\s　]*[:：]?', ''), '^[\s　]+', '') AS body0,
  regexp_replace(t, '^[0-9０-９]{1,2}[\s　]*[.．、][\s　]*', '') AS after FROM base b),
m0 AS (SELECT *, CASE WHEN ahead_ THEN body0 ELSE t END AS body, regexp_replace(' ' || CASE WHEN ahead_ THEN body0 ELSE t END, '[\s　]([0-9０-９]{1,2})(?:\.([\s　]*[^0-9０-９\s　])|\.([\s　]+[^\s　])|[．、]([\s　]*[^\s　]))', '§\1¶\2\3\4', 'g') AS cut FROM parts),
m1 AS (SELECT *, string_split(cut, '§') AS cs, regexp_extract_all(body, '([0-9０-９]{1,2})[\s　]*([A-DＡ-Ｄ]{1,4})([^A-Za-z0-9]|$)', 1) AS pn, regexp_extract_all(body, '([0-9０-９]{1,2})[\s　]*([A-DＡ-Ｄ]{1,4})([^A-Za-z0-9]|$)', 2) AS pb FROM m0),
m2 AS (SELECT *, CASE WHEN len(cs) < 2 THEN [] ELSE list_concat(CASE WHEN trim(cs[1], ' 　') <> '' THEN [CAST(NULL AS INTEGER)] ELSE [] END, list_transform(cs[2:], lambda x: CAST(translate(string_split(x, '¶')[1], '０１２３４５６７８９', '0123456789') AS INTEGER))) END AS marks,
  CASE WHEN len(cs) < 2 THEN [] ELSE list_concat(CASE WHEN trim(cs[1], ' 　') <> '' THEN [trim(cs[1], ' 　')] ELSE [] END, list_transform(cs[2:], lambda x: trim(x[position('¶' IN x) + 1 :], ' 　'))) END AS bodies,
  list_transform(pn, lambda x: CAST(translate(x, '０１２３４５６７８９', '0123456789') AS INTEGER)) AS pairs FROM m1),
f AS (SELECT b.doc, b.idx, b.r, b.kind, b.t, b.head, CASE WHEN b.head IS NOT NULL THEN b.rest0 END AS rest, b.body, b.marks, b.bodies, b.pairs, b.pb, NOT b.p AS tbl, b.t = '' AS blank, b.figs, coalesce(b.idx = o.at, FALSE) AS forced,
  NOT k.titled AND (k.evidence >= 3 OR k.asks >= 3) AS exercise, CASE WHEN regexp_matches(b.t, '^[0-9０-９]{1,2}\.[0-9０-９]{1,2}[\s　]*.') THEN 2 WHEN regexp_matches(b.t, '^(深圳外国语学校博雅高中|必修三|必修第三册|深外博雅|姓名[:：]|班级[:：]|第[一二三四五六七八九十]+章|学习目标与任务$)') THEN 1 ELSE 0 END AS above,
  regexp_matches(b.t, '^(课程基本信息|课题|教科书|书名[:：]|出版社[:：]|出版日期|学生信息|姓名|学校|班级|学号|推荐的学习资源)$') AS boiler,
  CASE WHEN b.isno THEN CAST(translate(regexp_extract(b.t, '^([0-9０-９]{1,2})', 1), '０１２３４５６７８９', '0123456789') AS INTEGER) END AS no,
  b.isno AND (regexp_matches(b.after, '^[-−+]?[0-9０-９]') OR regexp_matches(b.after, '^\\?[A-Za-z_$]') OR regexp_matches(b.after, '^[(（][0-9０-９]{1,2}[)）]') OR regexp_matches(b.after, '^(由|因|根据|解|答|故|选|设|当|若|则)')) AS value,
  b.opt IS NOT NULL AS option, regexp_matches(b.t, '^[（(][\s　]*[0-9０-９]{1,2}[\s　]*[）)]') AS paren,
  CASE b.head WHEN '课上学习任务' THEN 'task' WHEN '课堂探究' THEN 'task' WHEN '课后练习' THEN 'exercise' WHEN '课后作业' THEN 'exercise' WHEN '自我测评' THEN 'exercise' WHEN '课后练习答案' THEN 'answer' ELSE CASE WHEN b.head IS NOT NULL THEN 'list' END END AS hctx,
  CAST(translate(nullif(regexp_extract(CASE WHEN b.head IS NOT NULL THEN b.rest0 ELSE '' END, '^([0-9０-９]{1,2})[\s　]*[.．、][\s　]*[^\s　]', 1), ''), '０１２３４５６７８９', '0123456789') AS INTEGER) AS rest_no,
  coalesce(regexp_matches(CASE WHEN b.head IS NOT NULL THEN b.rest0 END, '^[A-DＡ-Ｄ][\s　]*[.．、][\s　]*[^\s　]'), FALSE) AS rest_option,
  nullif(regexp_extract(b.t, '^(【[\s　]*学习任务[^】]*】|【[\s　]*目标[^】]*】|【[\s　]*判断正误[\s　]*】)'), '') AS task, nullif(regexp_extract(b.t, '^《[^》]{1,20}》[\s　]*【[^】]{2,8}】'), '') AS piece,
  regexp_matches(b.t, '^【[^】]{2,10}】.{0,40}$') AND NOT regexp_matches(b.t, '^【[^】]*(答案|解析)') AS divider, b.ahead_ AS answer_head, b.body = '' AS bare,
  CAST(translate(nullif(regexp_extract(b.t, '^([0-9０-９]{1,2})[\s　]*[.．、]?[\s　]*(【[^】]*答案[^】]*】|参考答案|答案)', 1), ''), '０１２３４５６７８９', '0123456789') AS INTEGER) AS answer_no,
  regexp_matches(b.t, '^(【[^】]*解析[^】]*】|解析|详解|点拨)') AS explain, coalesce(a1.o, a2.o, a3.o, a4.o) AS letter, coalesce(a1.s, FALSE) OR coalesce(a2.s, FALSE) AS sub, coalesce(a1.q, FALSE) AS asks, a1 IS NOT NULL AND a1.o IS NULL AND a2.o IS NOT NULL AS stem, coalesce(a1.n, TRUE) AS numbered
  FROM m2 b LEFT JOIN ahead a ON a.doc = b.doc AND a.idx = b.idx JOIN kinds k ON k.doc = b.doc LEFT JOIN forced o ON o.doc = b.doc),
m AS (
  SELECT DISTINCT doc, CAST(0 AS BIGINT) AS r, CAST(NULL AS VARCHAR) AS act, CAST(NULL AS INTEGER) AS number, CAST(0 AS BIGINT) AS sid, CAST(0 AS BIGINT) AS grp, CAST(NULL AS BIGINT) AS qid, CASE WHEN exercise THEN 'exercise' ELSE 'list' END AS context,
    FALSE AS reading, CAST(NULL AS INTEGER) AS open, CAST(NULL AS INTEGER) AS question, FALSE AS begun, CAST(0 AS INTEGER) AS last, CAST([] AS INTEGER[]) AS answered, FALSE AS any_, FALSE AS near, FALSE AS titled, CAST(NULL AS BIGINT) AS waiting, FALSE AS force FROM f
  UNION ALL
  SELECT doc, r, act, number, sid + opened, grp + CAST(forced AS INTEGER) + CAST(act IN ('title', 'title_stem') AND hctx = 'exercise' AS INTEGER), CASE WHEN act IN ('stem', 'title_stem') THEN sid + opened ELSE qid END,
    CASE WHEN act IN ('title', 'title_stem') THEN hctx WHEN act = 'task' THEN CASE WHEN contains(task, '自我测评') THEN 'exercise' ELSE 'task' END WHEN act = 'divider' AND contains(t, '自我测评') THEN 'exercise' WHEN answer_head AND act IN ('answer_head', 'answers', 'pairs', 'answer') THEN 'answer' ELSE context END,
    CASE WHEN act = 'title' THEN hctx = 'answer' WHEN act IN ('title_stem', 'stem', 'task', 'piece') THEN FALSE WHEN act IN ('answers', 'pairs', 'answer', 'numbered_answer', 'explanation', 'more', 'answer_head') THEN TRUE ELSE reading END,
    CASE WHEN act = 'answers' THEN marks[-1] WHEN act IN ('answer', 'numbered_answer', 'explanation', 'more') THEN number WHEN act IN ('pairs', 'answer_head', 'title', 'title_stem', 'stem', 'task', 'piece') THEN NULL ELSE open END,
    CASE WHEN act IN ('title', 'task', 'piece', 'divider') THEN NULL WHEN act IN ('title_stem', 'stem') THEN number ELSE question END, begun, CASE WHEN act IN ('title_stem', 'stem') THEN number WHEN act = 'title' AND hctx = 'exercise' THEN 0 ELSE last END,
    CASE WHEN act IN ('title', 'title_stem') AND hctx = 'exercise' THEN [] WHEN act = 'answers' THEN list_distinct(list_concat(answered, list_transform(marks, lambda x: coalesce(x, 1)))) WHEN act = 'pairs' THEN list_distinct(list_concat(answered, pairs)) WHEN act IN ('answer', 'numbered_answer', 'explanation', 'more') THEN list_distinct(list_append(answered, number)) ELSE answered END,
    any_ OR act IN ('stem', 'title_stem'), act IN ('option', 'stem') OR (act = 'title_stem' AND rest_no IS NOT NULL),
    CASE WHEN act = 'title' THEN hctx = 'exercise' WHEN act IN ('title_stem', 'stem', 'task', 'piece', 'divider') THEN FALSE ELSE titled END,
    CASE WHEN act IN ('stem', 'title_stem') THEN NULL WHEN act = 'title' AND waits THEN coalesce(waiting, idx) ELSE waiting END,
    CASE WHEN act = 'stem' THEN FALSE WHEN act IN ('title', 'title_stem') AND waits THEN NOT numbered ELSE force END
  FROM (SELECT *, CASE act WHEN 'title_stem' THEN coalesce(rest_no, 1) WHEN 'stem' THEN coalesce(no, last + 1) WHEN 'option' THEN question WHEN 'answer' THEN question WHEN 'numbered_answer' THEN answer_no WHEN 'explanation' THEN open WHEN 'more' THEN open END AS number,
      CASE WHEN act = 'title_stem' THEN 2 WHEN act IN ('title', 'task', 'piece', 'divider', 'stem') THEN 1 ELSE 0 END AS opened FROM (
    SELECT * REPLACE (CASE WHEN passed THEN TRUE ELSE reading END AS reading), CASE WHEN pre IS NOT NULL THEN pre
      WHEN head IS NOT NULL AND NOT answer_head THEN CASE WHEN hctx = 'exercise' AND rest <> '' AND (rest_no IS NOT NULL OR letter IS NOT NULL OR ((waiting IS NOT NULL OR waits) AND rest_option)) THEN 'title_stem' ELSE 'title' END
      WHEN task IS NOT NULL THEN 'task' WHEN piece IS NOT NULL THEN 'piece' WHEN context = 'answer' AND len(marks) > 0 AND NOT answer_head THEN 'answers'
      WHEN answer_head AND bare THEN 'answer_head' WHEN answer_head AND len(marks) > 0 AND marks[1] IS NOT NULL THEN 'answers' WHEN answer_head AND len(pairs) >= 2 THEN 'pairs' WHEN answer_head AND question IS NOT NULL THEN 'answer' WHEN answer_no IS NOT NULL THEN 'numbered_answer'
      WHEN (reading OR passed) AND len(marks) > 0 AND marks[1] IS NOT NULL THEN 'answers' WHEN (reading OR passed) AND open IS NOT NULL THEN CASE WHEN explain THEN 'explanation' ELSE 'more' END WHEN divider THEN 'divider' WHEN context = 'exercise' AND (no IS NOT NULL OR force) THEN 'stem'
      WHEN option AND question IS NOT NULL THEN 'option' WHEN context = 'exercise' AND (near OR titled) AND NOT option AND NOT paren AND letter = 'A' THEN 'stem' ELSE 'text' END AS act FROM (
    SELECT * REPLACE (CASE WHEN leaves THEN FALSE ELSE reading END AS reading, CASE WHEN leaves THEN NULL ELSE open END AS open, CASE WHEN leaves AND context = 'answer' THEN 'exercise' ELSE context END AS context),
      hctx = 'exercise' AND figs AND (asks OR stem) AS waits, pre IS NULL AND (head IS NULL OR answer_head) AND task IS NULL AND piece IS NULL AND context = 'answer' AND NOT leaves AS passed FROM (
    SELECT *, coalesce(pre IS NULL AND reading AND no IS NOT NULL AND (list_contains(answered, no) OR letter = 'A' OR sub) AND NOT value, FALSE) AS leaves FROM (
    SELECT * REPLACE (begun OR (NOT tbl AND NOT blank AND above = 0) AS begun), CASE WHEN tbl THEN 'table' WHEN blank THEN CASE WHEN NOT figs THEN 'nothing' WHEN any_ AND context = 'exercise' THEN 'question_figure' ELSE 'figure' END WHEN NOT begun AND above = 2 THEN 'lesson' WHEN NOT begun AND above = 1 THEN 'nothing' WHEN boiler THEN 'nothing' END AS pre FROM (
    SELECT f.*, m.sid, m.grp, m.qid, CASE WHEN f.forced THEN 'exercise' ELSE m.context END AS context, m.reading, m.open, m.question, m.begun, CASE WHEN f.forced THEN 0 ELSE m.last END AS last, CASE WHEN f.forced THEN [] ELSE m.answered END AS answered, m.any_, m.near, m.titled, m.waiting, m.force
    FROM m JOIN f ON f.doc = m.doc AND f.r = m.r + 1))))))
),
d AS (SELECT f.*, m.act, m.number, m.sid, m.grp, m.qid FROM m JOIN f ON f.doc = m.doc AND f.r = m.r)
"""


def _sql(blocks: str, last: str) -> str:
    shapes = "[" + ", ".join(f"'{s}'" for s in SHAPES) + "]"
    titles = "课后练习答案|学习目标与任务|推荐的学习资源|课前学习任务|课上学习任务|课程基本信息|学习目标|课后练习|课后作业|课堂探究|自我测评"
    return _SQL.replace("<BLOCKS>", blocks).replace("<SHAPES>", shapes).replace("<N>", str(len(SHAPES))).replace("<TITLES>", titles) + last


_ACTS = "SELECT doc, idx, act, number, sid, grp, qid FROM d"


@query(_sql(_DOCUMENTS, _ACTS))
def section_blocks(spark: SparkSession, d: str) -> DataFrame:
    """What each line of a document is, and the section, group and question in which it stands."""
    return op.decisions(_documents(spark, d), texts=False).select("doc", F.col("idx").cast("long").alias("idx"), "act", "number", "sid", "grp", "qid")


@query(_sql(_CONVERSATIONS, _ACTS))
def section_turns(spark: SparkSession, d: str) -> DataFrame:
    return op.decisions(_conversations(spark, d), texts=False).select("doc", "idx", "act", "number", "sid", "grp", "qid")


@query(
    _sql(
        _DOCUMENTS,
        r"""SELECT doc, sid - CASE WHEN act = 'title_stem' THEN 1 ELSE 0 END AS sid, 'h' AS kind, head AS title, CAST(NULL AS INTEGER) AS no, CAST(NULL AS BIGINT) AS grp FROM d WHERE act IN ('title', 'title_stem')
UNION ALL SELECT doc, sid, CASE WHEN act IN ('stem', 'title_stem') THEN 'q' ELSE 'task' END, CASE act WHEN 'task' THEN task WHEN 'piece' THEN piece WHEN 'divider' THEN t END, number, CASE WHEN act IN ('stem', 'title_stem') THEN grp END FROM d WHERE act IN ('stem', 'title_stem', 'task', 'piece', 'divider')
UNION ALL SELECT DISTINCT doc, CAST(0 AS BIGINT), 'h', '正文', CAST(NULL AS INTEGER), CAST(NULL AS BIGINT) FROM d WHERE sid = 0 AND (act IN ('table', 'text') OR act = 'figure')""",
    )
)
def section_list(spark: SparkSession, d: str) -> DataFrame:
    return op.sections(durable(op.decisions(_documents(spark, d))))  # read several times


_ANSWERS = r""", a AS (SELECT doc, grp, idx, number AS no, 0 AS pos, CASE WHEN act IN ('explanation', 'more') THEN '解析' ELSE '答案' END AS tag,
  CASE act WHEN 'answer' THEN body WHEN 'numbered_answer' THEN regexp_replace(t, '^[0-9０-９]{1,2}[\s　]*[.．、]?[\s　]*(【[^】]*答案[^】]*】|参考答案|答案)[\s　]*[:：]?[\s　]*', '') WHEN 'explanation' THEN regexp_replace(t, '^(【[^】]*解析[^】]*】|解析|详解|点拨)[\s　]*[:：]?[\s　]*', '') ELSE t END AS text FROM d WHERE act IN ('answer', 'numbered_answer', 'explanation', 'more')
UNION ALL SELECT doc, grp, idx, coalesce(unnest(marks), 1), unnest(range(len(marks))), '答案', unnest(bodies) FROM d WHERE act = 'answers'
UNION ALL SELECT doc, grp, idx, unnest(pairs), unnest(range(len(pairs))), '答案', unnest(pb) FROM d WHERE act = 'pairs'),
g AS (SELECT doc, grp, no, CASE WHEN bool_or(tag = '解析') THEN '解析' ELSE '答案' END AS tag, count(*) AS parts, string_agg(text, chr(10) ORDER BY idx, pos) AS text FROM a GROUP BY 1, 2, 3)"""
_ANSWER_LIST = "SELECT doc, grp, no, row_number() OVER (PARTITION BY doc ORDER BY grp, no) AS place, tag, no || '．' || tag AS title, parts, text FROM g"


@query(_sql(_DOCUMENTS, _ANSWERS + _ANSWER_LIST))
def section_answers(spark: SparkSession, d: str) -> DataFrame:
    return op.answer_sections(op.answers(durable(op.decisions(_documents(spark, d)))))


_SECTIONS = r""", se AS (SELECT doc, sid - CASE WHEN act = 'title_stem' THEN 1 ELSE 0 END AS sid, 'h' AS kind, head AS title, CAST(NULL AS INTEGER) AS no, CAST(NULL AS BIGINT) AS grp FROM d WHERE act IN ('title', 'title_stem')
UNION ALL SELECT doc, sid, CASE WHEN act IN ('stem', 'title_stem') THEN 'q' ELSE 'task' END, CASE act WHEN 'task' THEN task WHEN 'piece' THEN piece WHEN 'divider' THEN t END, number, CASE WHEN act IN ('stem', 'title_stem') THEN grp END FROM d WHERE act IN ('stem', 'title_stem', 'task', 'piece', 'divider')
UNION ALL SELECT DISTINCT doc, CAST(0 AS BIGINT), 'h', '正文', CAST(NULL AS INTEGER), CAST(NULL AS BIGINT) FROM d WHERE sid = 0 AND (act IN ('table', 'text') OR act = 'figure')),
it AS (SELECT doc, CASE WHEN act = 'option' THEN qid ELSE sid END AS sid, idx, CASE WHEN act IN ('table', 'text', 'option') THEN t WHEN act = 'title' AND head <> '课后练习答案' THEN nullif(rest, '')
  WHEN act = 'title_stem' THEN regexp_replace(rest, '^[0-9０-９]{1,2}[\s　]*[.．、][\s　]*', '') WHEN act = 'stem' THEN regexp_replace(t, '^[0-9０-９]{1,2}[\s　]*[.．、][\s　]*', '')
  WHEN act = 'task' THEN nullif(regexp_replace(t, '^(【[\s　]*学习任务[^】]*】|【[\s　]*目标[^】]*】|【[\s　]*判断正误[\s　]*】)[\s　]*', ''), '') WHEN act = 'piece' THEN nullif(regexp_replace(t, '^《[^》]{1,20}》[\s　]*【[^】]{2,8}】[\s　]*', ''), '') END AS value
  FROM d WHERE act IN ('table', 'text', 'title', 'title_stem', 'task', 'piece', 'stem', 'option')),
bo AS (SELECT doc, sid, string_agg(value, chr(10) ORDER BY idx) AS body, bool_or(regexp_matches(regexp_replace(value, '<[^>]+>', '', 'g'), '^[\s　]*[A-DＡ-Ｄ]\s*[.、．]') OR regexp_matches(regexp_replace(value, '<[^>]+>', '', 'g'), '[A-DＡ-Ｄ]\s*[.、．][^。]{4,40}?[A-DＡ-Ｄ]\s*[.、．]')) AS options, sum(length(value)) AS chars FROM it WHERE value IS NOT NULL GROUP BY 1, 2),
b AS (SELECT se.*, body, options, chars FROM se LEFT JOIN bo USING (doc, sid)),
sh AS (SELECT doc, 0 AS part, sid AS place, 0 AS sub, CASE WHEN kind = 'q' THEN no || '．' ELSE title END AS line FROM b UNION ALL SELECT doc, 0, sid, 1, body FROM b WHERE body IS NOT NULL)"""


@query(_sql(_DOCUMENTS, _SECTIONS + " SELECT * FROM sh UNION ALL SELECT doc, 0, sid, 2, repeat('_', CASE WHEN coalesce(chars, 0) <= 130 THEN 3 WHEN chars <= 230 THEN 4 ELSE 6 END) FROM b WHERE kind = 'q' AND NOT coalesce(options, FALSE)"))
def edition_student(spark: SparkSession, d: str) -> DataFrame:
    """Titles and texts, with room after questions that have no options."""
    return edition(op.decisions(_documents(spark, d)), "student")


@query(
    _sql(
        _DOCUMENTS,
        _ANSWERS
        + _SECTIONS
        + """ SELECT * FROM sh UNION ALL SELECT b.doc, 0, b.sid, 2, '【' || coalesce(x.tag, y.tag) || '】' || coalesce(x.text, y.text) FROM b LEFT JOIN g x ON x.doc = b.doc AND x.grp = b.grp AND x.no = b.no AND trim(x.text) <> ''
LEFT JOIN g y ON y.doc = b.doc AND y.grp = 0 AND y.no = b.no AND trim(y.text) <> '' WHERE b.kind = 'q' AND coalesce(x.text, y.text) IS NOT NULL""",
    )
)
def edition_teacher(spark: SparkSession, d: str) -> DataFrame:
    """Titles and texts, with the answer after each question that has one."""
    return edition(op.decisions(_documents(spark, d)), "teacher")


@query(_sql(_DOCUMENTS, _ANSWERS + _SECTIONS + f" SELECT doc, 0 AS part, sid AS place, 1 AS sub, '{OPEN_TASK}' AS line FROM se WHERE kind = 'task' UNION ALL SELECT doc, 1, row_number() OVER (PARTITION BY doc ORDER BY grp, no), 0, no || '．' || tag || '　' || text FROM g"))
def edition_answers(spark: SparkSession, d: str) -> DataFrame:
    """A notice for each task, and the answers by group and number."""
    return edition(op.decisions(_documents(spark, d)), "answer")
