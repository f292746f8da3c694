"""What single lines of worksheets are: prompts to answer, options, equations, headers; pictures and formulas put in their places."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.operators.sectioning import trimmed

#: Words of a page's header; tokens that stand alone in it; words that ask for an answer; what ends a statement.
HEADER_WORDS = "课程基本信息 课例编号 学生信息 课题 姓名 出版社 书名 教科书 学期 学科 年级 出版日期".split()
HEADER_TOKENS = ["学", "科", "10", "物理"]
PROMPT_WORDS = "思考 想一想 做一做 试一试 议一议 讨论".split()
STATEMENT_ENDS = "。！；;"
#: Lines of a prompt with a number, of an equation in a sheet and on a slide.
PROMPT_CHARS, SHEET_CHARS, SLIDE_CHARS = 40, 80, 90
_MARK = r"[A-DＡ-Ｄ]\s*[.、．]"


def needs_answer(text: Column) -> Column:
    """Whether room for an answer follows: a question, a gap to fill, a word that asks, or a short numbered prompt that is no statement."""
    t = trimmed(text)
    gap = t.rlike("_{3}|＿{3}|[ \\x{3000}]{6}")
    asks = reduce(lambda a, b: a | b, [t.rlike(rf"^{w}\s*[0-9]*\s*[:：]") for w in PROMPT_WORDS])
    short = t.rlike(r"^[（(]?[0-9]{1,2}[）).．、]") & (F.length(t) <= PROMPT_CHARS) & ~F.right(t, F.lit(1)).isin(*STATEMENT_ENDS)
    return (F.length(t) >= 4) & (t.rlike("[?？]$") | gap | asks | short)


def has_option(text: Column) -> Column:
    """Whether a line begins with an option's mark, or two marks stand in one sentence with 4 to 40 characters between them."""
    t = trimmed(F.regexp_replace(text, "<[^>]+>", ""))
    return t.rlike(f"^{_MARK}") | t.rlike(f"{_MARK}[^。]{{4,40}}?{_MARK}")


def is_equation(text: Column, slide: bool = False) -> Column:
    """Whether a line is an equation that stands alone: signs and then an equals sign. In a sheet, a number before it is passed over."""
    if slide:
        t = trimmed(F.regexp_replace(text, "<[^>]+>", ""))
        return t.rlike(r"^[A-Za-z0-9φ𝑈|]+\s*[=＝]") & (F.length(t) < SLIDE_CHARS)
    t = F.regexp_replace(F.regexp_replace(trimmed(text), r"^[0-9]+\s*[.、．]\s*", ""), "<[^>]+>", "")
    return t.rlike(r"^[A-Za-z0-9=𝑊φ|]+\s*[=＝]") & (F.length(t) < SHEET_CHARS)


def is_header(text: Column, page: Column) -> Column:
    """Whether a line belongs to the header of the first page."""
    named = reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in HEADER_WORDS])
    return (page == 0) & (named | text.rlike("^[0-9]{4}QJ") | trimmed(text).isin(*HEADER_TOKENS))


def without_captions(html: Column) -> Column:
    """Markup without paragraphs that hold a picture's number only."""
    return F.regexp_replace(html, r"<p>\s*图\s*[0-9]+\s*</p>", "")


def inlined(pages: DataFrame, media: DataFrame, key: str, html: str) -> DataFrame:
    """(key, html, missing): pictures ``src="media/name"`` as data URIs of their bytes (``media`` has name, mime, content), and the sorted names that
    there are no bytes for, whose sources are empty. Only names that pages show are joined, each once a page."""
    pattern = 'src="media/([^"]+)"'
    shown = pages.select(key, html, F.split(html, pattern, -1).alias("__gaps"), F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("__names"))
    wanted = shown.select(key, F.explode(F.array_distinct("__names")).alias("name"))
    uri = F.concat(F.lit("data:"), "mime", F.lit(";base64,"), F.regexp_replace(F.base64("content"), r"\s", ""))
    found = wanted.join(media.select("name", uri.alias("uri")), "name", "left").groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("uri").isNotNull(), F.struct("name", "uri")))).alias("__uris"), F.array_sort(F.collect_list(F.when(F.col("uri").isNull(), F.col("name")))).alias("missing"),
    )
    none = F.create_map().cast("map<string,string>")
    joined = shown.join(found, key, "left").withColumns({"__uris": F.coalesce("__uris", none), "missing": F.coalesce("missing", F.array().cast("array<string>"))})
    source = lambda n: F.concat(F.lit('src="'), F.coalesce(F.try_element_at("__uris", n), F.lit("")), F.lit('"'))
    pieces = F.zip_with("__gaps", F.concat(F.transform("__names", source), F.array(F.lit(""))), lambda g, s: F.concat(g, s))
    return joined.select(key, F.when(F.size("__names") > 0, F.array_join(pieces, "")).otherwise(F.col(html)).alias("html"), "missing")


def corrected(formulas: DataFrame, corrections: DataFrame, text: str = "tex") -> DataFrame:
    """Formulas with what is known to be right for their decoded text (``corrections``: decoded, right), and ``fixed``. Of several corrections of one text, the
    smallest counts."""
    known = corrections.groupBy(F.col("decoded").alias(f"__{text}")).agg(F.min("right").alias("__right"))
    joined = formulas.join(known, F.col(text) == F.col(f"__{text}"), "left")
    return joined.withColumns({"fixed": F.col("__right").isNotNull(), text: F.coalesce("__right", text)}).drop(f"__{text}", "__right")


def answered(tasks: DataFrame, own: DataFrame, library: DataFrame, notice: str) -> DataFrame:
    """(task, answer, source): a task's own answer unless it is blank, else the library's, else the notice."""
    mine = own.where(F.trim("answer") != "").groupBy("task").agg(F.min("answer").alias("__own"))
    both = tasks.select("task").join(mine, "task", "left").join(library.select("task", F.col("answer").alias("__library")), "task", "left")
    source = F.when(F.col("__own").isNotNull(), "own").when(F.col("__library").isNotNull(), "library").otherwise("none")
    return both.select("task", F.coalesce("__own", "__library", F.lit(notice)).alias("answer"), source.alias("source"))
