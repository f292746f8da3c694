"""Column functions on lesson titles, answers and their markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANSWER_MARK, EXERCISE_TITLE, QUESTION_NUMBER = "答案", "课后练习", r"^\d{1,2}\s*[.．、]"
SPACES = r"[\s\x{3000}]+"


def lesson_key(title: Column) -> Column:
    """A title with single ASCII spaces."""
    return F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), SPACES, " "))


def spaceless(title: Column) -> Column:
    return F.regexp_replace(F.coalesce(title, F.lit("")), SPACES, "")


def document_name(path: Column) -> Column:
    """A file's name without folder, extension, spaces and the number of a copy; what is only an extension stays."""
    own = F.element_at(F.split(spaceless(path), "/"), -1)
    return F.regexp_extract(own, r"^(.*?.?)(?:\([0-9]+\))?(?:(?<=.)\.[^.]*)?$", 1)


def picture_kind(target: Column) -> Column:
    """``figure`` for numbers, ``decoration`` for brackets, ``text`` for a badge, whose text the name is."""
    return F.when(target.isNull() | picture_text(target).rlike(r"^[\d\-—]+$"), "figure").when(picture_text(target).rlike("左括|右括"), "decoration").otherwise("text")


def picture_text(target: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(target, r"([^/\\]*)$", 1), r"(?i)\.(tif|png|jpg|jpeg|emf|wmf)$", "")


def without_number(html: Column) -> Column:
    """Markup without the question's number. Before it stand pictures, elements with nothing in them, and white space, which stay; with anything else before it, or
    no number, the markup stays as it is."""
    nothing = r"(?:\s|<img[^>]*>|<(\w+)[^>]*>\s*</\2>)*"
    return F.trim(F.regexp_replace(html, rf"^({nothing})\d{{1,2}}\s*[.．、]\s*", "$1"))


def splice(text: Column, places: Column, new: str, size: int) -> Column:
    """The text with ``size`` characters at each of the places (from 0) replaced; the last place comes first, so that places hold."""
    late_first = F.reverse(F.array_sort(F.array_distinct(places)))
    return F.aggregate(late_first, text, lambda t, p: F.concat(F.left(t, p), F.lit(new), F.substr(t, p + 1 + size)))
