"""Main text of web pages by template deduction over pages of the same host.

A token is a block-level tag, or the text of a whole block over its inline elements, with the path of block-level elements that
it stands in. Over the pages of a host, tokens with equal occurrence vectors (how often they occur on which pages; compared by
sums of hashes, the same in any order) form an equivalence class. Classes that are large (three tokens) and frequent (a tenth
of the host's pages, three at least) belong to the template. On a page, a class is valid if its tokens stand in the template's
order; classes nest by their paths. What stands between the tokens of valid classes fills slots, each known by the innermost
template element around it. Over the host's pages it is counted how much text a slot holds, how much of it is linked, and how much
is itself part of the template. That decides which slots are read:

* the host's main element is the innermost template element that holds three fifths of the text that is neither linked nor the
  template's own (an ``article`` or ``main`` around or in it is preferred); what lies outside of it goes;
* inside, text that is part of the template goes, unless it is four fifths of what the main element has, as on copies of one article;
* inside, slots whose text is nearly all linked go.

Names only help where statistics cannot tell: elements that are navigation, forms or asides by their very name go, and so do those
whose class, id or role says so with all of its words; of two elements with the same text, the one named as the main one is taken. Hosts with fewer
than three different pages have no template; there, names and a page's own text decide.

Token counts are aggregated per host with partial sums, so a host with a third of all pages costs no task more than others. Equal
pages count once. A template is bounded by ten pages' tokens; templates are broadcast only after a check of their size, else joined by a
shuffle.

Defined cases: null and empty html give the empty text; pages without a url make one host; repeated pages each get their row; broken
html is read as far as it goes: a quote that is not closed before another tag ends with its tag.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.common import durable, mapped

SMALL_TOKENS = 100_000
LEAST_PAGES, LEAST_SHARE, LEAST_TOKENS = 3, 0.1, 3
#: Text of the template stands on half of the host's pages; a slot is a menu if so much of its text is linked.
OFTEN, LINKED, MAIN_SHARE, COPIES = 0.5, 0.8, 0.6, 0.8

#: Fixed values of HTML: elements without an end, whose content is no text, and that flow inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg select option button object canvas audio video annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math mfrac mi mn mo mover mrow ms msqrt mroot mstyle msub msubsup msup mtext munder "
    "munderover q rp rt ruby s samp semantics small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_SELF = frozenset("p li dt dd tr td th option".split())
SECTIONS = frozenset("article aside body div footer form header main nav section table ul ol dl blockquote figure html fieldset details dialog".split())

#: Elements, and words of class, id or role, that hold no article text, and words that say where such a thing stands.
APART = frozenset("nav footer aside form menu dialog".split())
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead cookie cookies consent notice notices alert popup modal overlay comment comments disqus replies reply share sharing social "
    "related recommended newsletter subscribe subscription signup login search searchbox widget toolbar pagination pager skip copyright contentinfo "
    "complementary".split()
)
NEUTRAL_WORDS = frozenset(
    "area article articles bar block body bottom box button buttons col column container content entry form foot global group head header heading inner item items left link "
    "links list main media message module outer page pages panel post posts primary reader right row secondary section site slot stories story text the thread title top unit user "
    "view wrap wrapper".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^\s"'<>/=][^\s<>/=]*+(?:\s*+=\s*+(?:"[^"]*+"(?=[\s/>])|'[^']*+'(?=[\s/>])|[^\s"'<>][^\s<>]*+)?+)?+|[\s/"'=])*+)(?:>|(?=<)|$)""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


@dataclass
class Text:
    value: str  # "" marks a break between blocks
    path: int
    linked: bool


@dataclass
class Page:
    """Paths are known by number; ``up`` has each one's parent, and 0 is the page itself."""

    texts: list[Text] = field(default_factory=list)
    up: list[int] = field(default_factory=lambda: [-1])
    element: list[str] = field(default_factory=lambda: [""])
    token: list[int] = field(default_factory=lambda: [0])  # a hash of the whole path
    apart: list[bool] = field(default_factory=lambda: [False])
    main: list[bool] = field(default_factory=lambda: [False])  # in an article or main element
    opened: list[int] = field(default_factory=list)  # the path of each tag, in page order


def _hash(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _says_apart(values: list[str]) -> bool:
    """Whether a class, id or role says with all of its words that an element is set apart."""
    for value in values:
        words = [w for w in re.split(r"[^a-z]+", value.lower()) if w]
        if any(w in APART_WORDS for w in words) and all(w in APART_WORDS or w in NEUTRAL_WORDS for w in words):
            return True
    return False


def parse(html: str) -> Page:
    page = Page()
    known: dict[tuple[int, str], int] = {}
    stack: list[str] = []
    paths = [0]
    links = 0
    low = None

    def open_element(name: str, attributes: str) -> None:
        values = [v for own in _NAMES.findall(attributes) for v in "".join(own).split()]
        words = sorted({w for v in values for w in re.split(r"[^a-z]+", v.lower()) if w})
        element, parent = name + "".join("." + w for w in words), paths[-1]
        at = known.get((parent, element))
        if at is None:
            at = known[parent, element] = len(page.up)
            main = name in ("article", "main") or "main" in values
            inside = page.main[parent]
            plain = name in ("html", "body", "article", "main")
            apart = name in APART or (name == "header" and not inside) or (not plain and _says_apart(values))
            # A class of what is around an article does not set it apart; an element's own name does.
            above = page.apart[parent] if inside or not main else any(page.element[p].split(".")[0] in APART for p in _ancestors(page, parent))
            page.up.append(parent)
            page.element.append(element)
            page.token.append(_hash(page.token[parent], element))
            page.apart.append(above or apart)
            page.main.append(inside or main)
        stack.append(name)
        paths.append(at)
        page.opened.append(at)

    def close(to: int) -> None:
        del stack[to:], paths[to + 1 :]

    def text(value: str) -> None:
        if value:
            page.texts.append(Text(value, paths[-1], links > 0))

    def pause() -> None:
        if page.texts and page.texts[-1].value:
            page.texts.append(Text("", paths[-1], False))

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = max(m.end(), m.start() + 1)
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name == "a":
                links = max(0, links - 1)
            elif name not in INLINE:
                pause()
                if name in stack:
                    close(len(stack) - 1 - stack[::-1].index(name))
            continue
        if name in RAW:
            if not m[3].rstrip().endswith("/"):
                low = low or html.lower()
                end = low.find("</" + name, at)
                at = n if end < 0 else end
            pause()
            continue
        if name == "a":
            links += 1
        if name in INLINE:
            continue
        pause()
        if name in VOID or name == "head":
            continue
        # A new paragraph or section ends an open paragraph; an item ends the item before it.
        for k in range(len(stack) - 1, -1, -1):
            if stack[k] in SECTIONS and not (name in SECTIONS and stack[k] == "p"):
                break
            if (stack[k] == name and name in CLOSED_BY_SELF) or stack[k] == "p":
                close(k)
                break
        open_element(name, m[3])
    return page


def _ancestors(page: Page, path: int):
    while path > 0:
        yield path
        path = page.up[path]


def _clean(value: str) -> str:
    return " ".join(html_lib.unescape(value).split())


def _whole_blocks(page: Page) -> list[tuple[int, int, str]]:
    """(start, end, text) of the pieces that make up each block; inline markup parts a block into several."""
    out, n, k = [], len(page.texts), 0
    while k < n:
        start = k
        while k < n and page.texts[k].value:
            k += 1
        if v := _clean("".join(t.value for t in page.texts[start:k])):
            out.append((start, k, v))
        k += 1
    return out


def _densest(page: Page) -> int:
    """The innermost element with three fifths of the unlinked text that isn't set apart."""
    own = [0] * len(page.up)
    for t in page.texts:
        if t.value and not t.linked and not page.apart[t.path]:
            own[t.path] += len(t.value.strip())
    for p in range(len(page.up) - 1, 0, -1):
        own[page.up[p]] += own[p]
    # Numbers grow inwards, and at most one element of those side by side has so much.
    return max((p for p in range(len(own)) if own[0] and own[p] >= MAIN_SHARE * own[0] and (p == 0 or page.element[p].split(".")[0] in SECTIONS)), default=0)


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


#: Kinds of counted tokens.
TAG, TEXT, PAGE = 0, 1, 2


def _page_tokens(page: Page) -> dict[tuple[int, int], list]:
    """(kind, token) to [count, first position, parent's token, named as main, set apart, unlinked and linked characters inside]."""
    out: dict[tuple[int, int], list] = {(PAGE, 0): [1, 0, 0, False, False, 0, 0]}
    inside = [[0, 0] for _ in page.up]
    for start, end, v in _whole_blocks(page):
        path = page.texts[start].path
        own = out.setdefault((TEXT, _hash("text", page.token[path], v)), [0, start, page.token[path], False, page.apart[path], 0, 0])
        own[0] += 1
        for t in page.texts[start:end]:
            size = len(t.value.strip())
            own[5 + t.linked] += size
            inside[path][t.linked] += size
    for p in range(len(page.up) - 1, 0, -1):  # a parent has the smaller number
        inside[page.up[p]][0] += inside[p][0]
        inside[page.up[p]][1] += inside[p][1]
    for k, p in enumerate(page.opened):
        named = page.element[p].split(".")[0] in ("article", "main")
        out.setdefault((TAG, page.token[p]), [0, k, page.token[page.up[p]], named, page.apart[p], *inside[p]])[0] += 1
    return out


_COUNTED = "host string, kind int, token bigint, page bigint, n int, position int, parent bigint, named boolean, apart boolean, plain bigint, linked bigint"


def page_tokens(pages: DataFrame) -> DataFrame:
    """The tokens of each page, with the key of the page."""
    names, kinds = zip(*(x.split() for x in _COUNTED.split(", ")), strict=True)
    types = [{"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}[k] for k in kinds]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for url, html, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            host = host_of(url)
            rows += [(host, kind, token, key, *counted) for (kind, token), counted in _page_tokens(parse(html or "")).items()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))

    return mapped(pages.select("url", "html", "key"), run, _COUNTED)


_HOST = r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def _host(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _HOST, 1))


def host_templates(pages: DataFrame) -> DataFrame:
    """One row per host with enough pages: its template's tokens."""
    keyed = pages.select("url", "html", F.xxhash64(_host("url"), "html").alias("key"))
    copied = durable(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("key"))
    small = copied.count() <= SMALL_TOKENS
    copied = F.broadcast(copied) if small else copied
    # Only pages with copies need their tokens compared.
    once = page_tokens(keyed.join(copied, "key", "left_anti"))
    again = page_tokens(keyed.join(copied, "key", "left_semi")).dropDuplicates(["host", "kind", "token", "page"])
    vector = F.xxhash64("page", "n")
    found = once.unionByName(again).groupBy("host", "kind", "token").agg(
        F.count(F.lit(1)).alias("support"),
        F.sum(F.shiftrightunsigned(vector, 32)).alias("high"),
        F.sum(vector.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.avg("position").alias("place"),
        F.min("parent").alias("parent"),
        F.max("named").alias("named"),
        F.max("apart").alias("apart"),
        F.sum("plain").alias("plain"),
        F.sum("linked").alias("linked"),
    )
    found = durable(found)
    sizes = found.where(F.col("kind") == PAGE).select("host", F.col("support").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    often = found.where(F.col("kind") != PAGE).join(sizes, "host")
    often = often.where((F.col("support") >= LEAST_PAGES) & (F.col("support") >= LEAST_SHARE * F.col("pages")))
    often = often.withColumns({"share": F.col("support") / F.col("pages"), "vector": F.xxhash64("support", "high", "low")})
    token = F.struct("vector", "place", "kind", "token", "parent", "share", "named", "apart", "plain", "linked")
    classes = often.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("size"), F.collect_list(token).alias("tokens")).where(F.col("size") >= LEAST_TOKENS)
    return classes.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))


@dataclass
class Template:
    tags: dict[int, tuple[int, int]]  # token to (class, order)
    texts: set[int]  # of blocks that are the template's own
    menus: set[int]  # tokens of slots whose text is linked
    main: int | None  # the main element's token


def read_template(tokens: list[dict] | None) -> Template | None:
    """Decide what each slot of the template is."""
    if not tokens:
        return None
    tags = {t["token"]: t for t in tokens if t["kind"] == TAG}
    rank = {t: r for r, t in enumerate(sorted(tags, key=lambda t: (tags[t]["place"], t)))}
    texts = {t["token"]: t for t in tokens if t["kind"] == TEXT and t["share"] >= OFTEN}
    # Text of each slot with all in it: unlinked, linked, unlinked and part of the template.
    inside = {t: [own["plain"], own["linked"], 0] for t, own in tags.items()}
    for own in texts.values():
        for t in _chain(tags, own["parent"]):
            inside[t][2] += own["plain"]
    menus = {t for t, (plain, linked, _) in inside.items() if linked > 0 and linked >= LINKED * (plain + linked)}
    # Where nearly all text is the template's own, the pages are copies of one article.
    plain, _, fixed = max(inside.values(), default=(0, 0, 0))
    copies = fixed > COPIES * plain
    weight = {t: plain - fixed * (not copies) for t, (plain, _, fixed) in inside.items() if not tags[t]["apart"]}
    most = max(weight.values(), default=0)
    main = None
    if most > 0:
        rich = [t for t in weight if weight[t] >= MAIN_SHARE * most]
        deep = max(rich, key=lambda t: (_depth(tags, t), weight[t], t))
        around = [t for t in _chain(tags, deep) if tags[t]["named"]]
        below = [t for t in weight if tags[t]["named"] and weight[t] >= MAIN_SHARE * weight[deep] and deep in _chain(tags, t)]
        main = around[-1] if around else min(below, key=lambda t: _depth(tags, t)) if below else deep
    fixed = set(texts)
    if main is not None and inside[main][2] > COPIES * inside[main][0]:
        fixed = {t for t in texts if main not in _chain(tags, texts[t]["parent"])}
    return Template({t: (own["vector"], rank[t]) for t, own in tags.items()}, fixed, menus, main)


def _chain(tags: dict[int, dict], token: int) -> list[int]:
    """The template elements from a token outwards."""
    out = []
    while token in tags and token not in out:
        out.append(token)
        token = tags[token]["parent"]
    return out


def _depth(tags: dict[int, dict], token: int) -> int:
    own = tags[token]
    if "depth" not in own:
        for t in reversed(_chain(tags, token)):
            tags[t]["depth"] = tags[tags[t]["parent"]]["depth"] + 1 if tags[t]["parent"] in tags else 0
    return own["depth"]


def valid_elements(page: Page, template: Template) -> set[int]:
    """Tokens of the page's elements that belong to valid classes: those whose tokens' first occurrences stand in the template's order."""
    first: dict[int, int] = {}
    for k, p in enumerate(page.opened):
        if page.token[p] in template.tags:
            first.setdefault(page.token[p], k)
    by_class: dict[int, list[tuple[int, int]]] = {}
    for token, k in first.items():
        own, rank = template.tags[token]
        by_class.setdefault(own, []).append((k, rank))
    valid = {c for c, own in by_class.items() if (order := [r for _, r in sorted(own)]) == sorted(order)}
    return {t for t in first if template.tags[t][0] in valid}


def main_text(html: str, template: Template | None) -> str:
    page = parse(html)
    n = len(page.up)
    valid = valid_elements(page, template) if template else set()
    # Whether what a path holds is read: it lies in the main element, and in no slot that goes.
    inside, menu = [False] * n, [False] * n
    if template and template.main in valid:
        mains = {p for p in range(n) if page.token[p] == template.main}
    elif any(page.main):
        mains = {p for p in range(n) if page.main[p]}
    else:
        mains = {_densest(page)}
    for p in range(n):
        parent = page.up[p]
        inside[p] = p in mains or (parent >= 0 and inside[parent])
        menu[p] = (parent >= 0 and menu[parent]) or bool(template and page.token[p] in valid and page.token[p] in template.menus)
    gone = set()
    if template and template.texts:
        gone = {k for start, end, v in _whole_blocks(page) if _hash("text", page.token[page.texts[start].path], v) in template.texts for k in range(start, end)}
    out = []
    for k, t in enumerate(page.texts):
        read = t.value and inside[t.path] and not page.apart[t.path] and not menu[t.path] and k not in gone
        out.append(html_lib.unescape(t.value) if read else " ")
    return " ".join("".join(out).split())


def extract_text(pages: DataFrame, html: str = "html", url: str = "url", name: str = "__text") -> DataFrame:
    """All columns of ``pages`` and the main text."""
    templates = durable(host_templates(pages.select(F.col(url).alias("url"), F.col(html).alias("html"))))
    names = pages.columns
    n = len(names)
    schema = pages.withColumn(name, F.lit("")).schema
    size = templates.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0]
    brief = templates.select(F.col("host").alias("__host"), F.col("tokens").alias("__tokens"))
    if size <= SMALL_TOKENS:
        table = {r[0]: read_template([t.asDict() for t in r[1] or ()]) for r in brief.toLocalIterator()}
        shared = pages.sparkSession.sparkContext.broadcast(table)
        found = pages.withColumn("__host", _host(url))
    else:
        shared = None
        found = pages.withColumn("__at", _host(url)).join(brief, F.col("__at") == F.col("__host"), "left").drop("__at")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict = shared.value if shared else {}
        texts = []
        for r, (value, own) in enumerate(zip(batch.column(names.index(html)).to_pylist(), batch.column(n).to_pylist(), strict=True)):
            if not shared and own is not None and own not in known:  # once per batch and host
                known[own] = read_template(batch.column(n + 1)[r].as_py())
            texts.append(main_text(value or "", known.get(own)))
        return pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], names=[*names, name])

    return mapped(found, run, schema)


def op3_html(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    found = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))
