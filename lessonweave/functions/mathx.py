"""Formula markup: LaTeX to html, Office math to LaTeX, html offsets. Small functions on one value each,
applied to Arrow batches; everything around them stays in DataFrame operations."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Commands that stand for one character, and functions that are set upright.
SIGNS = {"alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "theta": "θ", "lambda": "λ", "mu": "μ", "pi": "π", "rho": "ρ", "phi": "φ", "omega": "ω", "Delta": "Δ", "Omega": "Ω", "times": "×", "div": "÷", "pm": "±", "cdot": "·", "le": "≤", "ge": "≥", "ne": "≠", "approx": "≈", "infty": "∞", "to": "→", "circ": "°", "%": "%"}
UPRIGHT = frozenset("sin cos tan cot ln lg log lim max min".split())
_LEX = re.compile(r"\\([a-zA-Z]+|.)|([{}^_\[\]])|\s+|([^\\{}^_\[\]\s]+)")


def latex_to_html(tex: str | None) -> str | None:
    """Fractions as ``a/b``, roots with their index, sub- and superscripts as tags; unknown commands keep
    their name."""
    if tex is None:
        return None
    tokens = [m for m in _LEX.finditer(tex)]
    at = 0

    def group() -> str:
        """The next argument: a braced group or one atom."""
        nonlocal at
        while at < len(tokens) and tokens[at][0].isspace():
            at += 1
        if at < len(tokens) and tokens[at][0] == "{":
            at += 1
            out = sequence("}")
            at += at < len(tokens)
            return out
        return atom() if at < len(tokens) else ""

    def atom() -> str:
        nonlocal at
        m = tokens[at]
        if m[3] and len(m[3]) > 1 and at and tokens[at - 1][0] in ("^", "_"):
            # A script takes one character of a longer run.
            rest, first = m[3][1:], m[3][0]
            tokens[at : at + 1] = [_LEX.match(first), _LEX.match(rest)]
            m = tokens[at]
        at += 1
        if m[1]:
            name = m[1]
            if name in ("frac", "dfrac", "tfrac"):
                a, b = group(), group()
                wrap = lambda x: x if re.fullmatch(r"\w*|<i>\w</i>", x) else f"({x})"
                return f"{wrap(a)}/{wrap(b)}"
            if name == "sqrt":
                index = ""
                if at < len(tokens) and tokens[at][0] == "[":
                    at += 1
                    index = f"<sup>{sequence(']')}</sup>"
                    at += at < len(tokens)
                return f"{index}√({group()})"
            if name in ("rm", "mathrm", "text", "left", "right", "displaystyle"):
                return ""
            return SIGNS.get(name, name if name in UPRIGHT or not name.isalpha() else name)
        if m[0] == "{":
            at -= 1
            return group()
        if m[0] == "^":
            return f"<sup>{group()}</sup>"
        if m[0] == "_":
            return f"<sub>{group()}</sub>"
        return "" if m[0].isspace() else html.escape(m[0], quote=False)

    def sequence(end: str) -> str:
        out = []
        while at < len(tokens) and tokens[at][0] != end:
            out.append(atom())
        return "".join(out)

    out = []
    while at < len(tokens):
        if tokens[at][0] == "}":
            at += 1
        else:
            out.append(atom())
    return "".join(out)


def omml_to_latex(xml: str | None) -> str | None:
    """Office math: fractions, scripts, delimiters, radicals, n-ary operators, functions, accents, matrices.
    Null for what is not well-formed."""
    if xml is None:
        return None
    try:
        return _omml(ET.fromstring(xml)).strip()
    except ET.ParseError:
        return None


def _omml(e: ET.Element) -> str:
    name = e.tag.rpartition("}")[2]
    own = {c.tag.rpartition("}")[2]: c for c in e}
    part = lambda k: "".join(_omml(c) for c in own[k]) if k in own else ""
    value = lambda k, default: next((v for c in (own.get(name + "Pr") if own.get(name + "Pr") is not None else ()) if c.tag.endswith("}" + k) for v in c.attrib.values()), default)
    if name == "t":
        return e.text or ""
    if name == "f":
        return rf"\frac{{{part('num')}}}{{{part('den')}}}"
    if name in ("sSub", "sSup", "sSubSup"):
        return part("e") + (f"_{{{part('sub')}}}" if "sub" in own else "") + (f"^{{{part('sup')}}}" if "sup" in own else "")
    if name == "d":
        return value("begChr", "(") + ",".join("".join(_omml(c) for c in x) for x in e if x.tag.endswith("}e")) + value("endChr", ")")
    if name == "rad":
        return rf"\sqrt[{part('deg')}]{{{part('e')}}}" if part("deg") else rf"\sqrt{{{part('e')}}}"
    if name == "nary":
        return value("chr", "∫") + (f"_{{{part('sub')}}}" if part("sub") else "") + (f"^{{{part('sup')}}}" if part("sup") else "") + part("e")
    if name == "func":
        return rf"\{part('fName').strip()} {part('e')}"
    if name == "acc":
        return rf"\overline{{{part('e')}}}"
    if name == "m":
        rows = [" & ".join("".join(_omml(c) for c in cell) for cell in row if cell.tag.endswith("}e")) for row in e if row.tag.endswith("}mr")]
        return r"\begin{matrix}" + r" \\ ".join(rows) + r"\end{matrix}"
    return "" if name.endswith("Pr") else "".join(_omml(c) for c in e)


def plain_map(value: str | None) -> tuple[str, list[int]] | None:
    """The text of html without tags, and the offset in the html of each of its characters. References
    are one character."""
    if value is None:
        return None
    plain, at = [], []
    for m in re.finditer(r"<[^>]*>|&#?\w+;|.", value, re.S):
        if m[0][0] != "<" or len(m[0]) == 1:
            for c in html.unescape(m[0]):
                plain.append(c)
                at.append(m.start())
    return "".join(plain), at


_MARK = re.compile(r"(?<![0-9A-Za-z])([A-H])[.．]")


def split_options(text: str | None) -> tuple[str, list[str]] | None:
    """A question's stem and its options. Marks inside ``$…$`` and after an ASCII letter or digit do not count;
    options must begin with A and follow the alphabet, else all is the stem."""
    if text is None:
        return None
    blank = re.sub(r"\$[^$]*\$", lambda m: "$" * len(m[0]), text)
    marks, want = [], "A"
    for m in _MARK.finditer(blank):
        if m[1] == want:
            marks.append(m.start())
            want = chr(ord(want) + 1)
    if len(marks) < 2:
        return text, []
    ends = [*marks[1:], len(text)]
    return text[: marks[0]].strip(), [text[a:b].strip() for a, b in zip(marks, ends, strict=True)]


@F.pandas_udf(T.StringType())
def latex_html(s: pd.Series) -> pd.Series:
    return s.map(latex_to_html)


@F.pandas_udf(T.ArrayType(T.StringType()))
def latex_htmls(s: pd.Series) -> pd.Series:
    """Arrays of formulas; each different one of a batch is converted once."""
    known = {x: latex_to_html(x) for x in {x for xs in s if xs is not None for x in xs}}
    return s.map(lambda xs: None if xs is None else [known[x] for x in xs])


@F.pandas_udf(T.StringType())
def omml_latex(s: pd.Series) -> pd.Series:
    return s.map(omml_to_latex)


@F.pandas_udf(T.StructType().add("plain", T.StringType()).add("at", T.ArrayType(T.IntegerType())))
def html_offsets(s: pd.Series) -> pd.DataFrame:
    """Offsets are packed page by page, as a batch of pages has many."""
    return pd.DataFrame([(m[0], np.array(m[1], np.int32)) if (m := plain_map(x)) else (None, None) for x in s], columns=["plain", "at"])


@F.pandas_udf(T.StructType().add("stem", T.StringType()).add("options", T.ArrayType(T.StringType())))
def question_options(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([split_options(x) or (None, None) for x in s], columns=["stem", "options"])
