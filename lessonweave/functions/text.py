"""Scalar text functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s　]+"


def sanitize(name: Column, most: int = 80) -> Column:
    """A file name: characters that paths forbid become ``_``, spaces collapse, at most ``most`` characters."""
    x = F.regexp_replace(F.coalesce(name, F.lit("")), r"""[\\/:*?"<>|\x00-\x1f]+""", "_")
    x = F.substring(F.regexp_replace(F.regexp_replace(x, SPACE, " "), "^ | $", ""), 1, most)
    return F.when(x == "", "unnamed").otherwise(x)


def title_to_file(title: Column) -> Column:
    return F.regexp_replace(F.translate(title, "/（）", "_()"), SPACE, "")


def period_of(title: Column) -> Column:
    """The lesson period in full-width parentheses, else the empty text."""
    return F.regexp_extract(title, "（([^）]*课时)）", 1)


def after_first_dot(name: Column) -> Column:
    return F.regexp_replace(name, r"^[^.]*\.", "")


def before_middle_dot(title: Column) -> Column:
    return F.regexp_replace(F.split_part(title, F.lit("·"), F.lit(1)), r"^[\s　]+|[\s　]+$", "")


def escape_html(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


def inject_css(html: Column, css: str) -> Column:
    """Before the last ``</style>``."""
    return F.regexp_replace(html, "(?s)^(.*)</style>", "$1" + css.replace("$", r"\$") + "</style>")


def line_breaks(text: Column) -> Column:
    """Text as html: html stays as it is, plain text is escaped and its line ends become ``<br>``."""
    return F.when(F.contains(text, F.lit("<")), text).otherwise(F.replace(escape_html(text), F.lit("\n"), F.lit("<br>")))


def coalesce_runs(html: Column) -> Column:
    """``<sup>a</sup><sup>b</sup>`` becomes one run; the same for sub, b and i."""
    return F.regexp_replace(html, "</(sup|sub|b|i)><\\1>", "")


def field_to_latex(field: Column) -> Column:
    r"""A word processor's ``\f(a,b)`` field as ``\frac{a}{b}``, up to four levels deep; null if there is none."""
    out = field
    for _ in range(4):
        out = F.regexp_replace(out, r"\\f\(([^(),]*),([^(),]*)\)", r"\\frac{$1}{$2}")
    return F.when(out != field, out)


def clean_latex(tex: Column) -> Column:
    """Spaces and wrappers that carry no meaning go; synonyms become one command."""
    out = F.regexp_replace(tex, r"\\(?:rm|mathrm|text)\s*", "")
    for a, b in ((r"\\left\s*", ""), (r"\\right\s*", ""), (r"\\dfrac", r"\\frac"), (r"\\leqslant", r"\\le"), (r"\\geqslant", r"\\ge"), (r"\\(?:,|;|!|quad)", " "), (r"\s+", " ")):
        out = F.regexp_replace(out, a, b)
    return F.trim(out)


def fold_math(text: Column) -> Column:
    """Mathematical alphanumerics (a block of styled letters and digits) as plain ones, by rule: each style
    repeats A-Z, a-z; each Greek style has the capitals, nabla, the small letters and their variants; the digits follow in groups of ten."""
    latin = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    row = lambda a, b: "".join(map(chr, range(a, b)))
    greek = row(0x391, 0x3A2) + "ϴ" + row(0x3A3, 0x3AA) + "∇" + row(0x3B1, 0x3CA) + "∂ϵϑϰϕϱϖ"
    styled = row(0x1D400, 0x1D6A4) + row(0x1D6A8, 0x1D6A8 + 5 * len(greek)) + row(0x1D7CE, 0x1D800)
    plain = "".join(latin[i % 52] for i in range(0x1D6A4 - 0x1D400)) + greek * 5 + "0123456789" * 5
    return F.translate(text, styled, plain)


#: Private-use code points of the Symbol font and what they stand for, by the font's public encoding.
SYMBOLS = {
    "\uf02b": "+", "\uf03c": "<", "\uf03d": "=", "\uf044": "Δ", "\uf057": "Ω", "\uf061": "α", "\uf062": "β", "\uf065": "ε", "\uf066": "φ", "\uf067": "γ", "\uf06a": "φ", "\uf06c": "λ",
    "\uf06d": "μ", "\uf070": "π", "\uf071": "θ", "\uf0a3": "≤", "\uf0a8": "♦", "\uf0ac": "←", "\uf0ae": "→", "\uf0b0": "°", "\uf0b1": "±", "\uf0b3": "≥", "\uf0b4": "×", "\uf0b8": "÷",
}


def map_symbols(text: Column, font: Column) -> Column:
    return F.when(F.contains(F.lower(font), F.lit("symbol")), F.translate(text, "".join(SYMBOLS), "".join(SYMBOLS.values()))).otherwise(text)


def timestamp_srt(seconds: Column) -> Column:
    """``HH:MM:SS,mmm``; milliseconds are rounded first, so that they carry."""
    ms = F.bround(seconds * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.expr("0L") + F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def table_html(rows: Column) -> Column:
    """An array of arrays of cells as an html table whose first row is the head."""
    cells = lambda r, tag: F.array_join(F.transform(r, lambda c: F.concat(F.lit(f"<{tag}>"), escape_html(c), F.lit(f"</{tag}>"))), "")
    lines = F.transform(rows, lambda r, i: F.concat(F.lit("<tr>"), F.when(i == 0, cells(r, "th")).otherwise(cells(r, "td")), F.lit("</tr>")))
    return F.concat(F.lit("<table>"), F.array_join(lines, ""), F.lit("</table>"))
