"""Personal data by weak supervision, with DataFrame functions only.

Candidate spans come from patterns. Three labelers vote on each: the form of the span (``regex``), lists of
known names (``gazetteer``) and the words before it (``context``). Over the whole corpus the votes are
counted by pattern of votes, a table whose size does not grow with the data; expectation-maximisation over
these counts estimates each labeler's reliability and the chance that a span with such votes is real. These
chances train a logistic span classifier, on the same counts, over votes and shape. Spans of the base kinds
that pass their own checks always stay; the classifier decides about all other candidates.

Positions are code points, ends exclusive. Patterns use possessive repeats and look-behinds that accept the
same spans as plain ones but take linear time and no stack.

Defined cases: a null text is empty and has no spans; repeated rows each get their row; without candidates
the classifier accepts nothing beyond the base.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.common import durable
from lessonweave.llm.spans import joined, matches

_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Numbers of fewer than 13 digits were never candidates.
_CARD = r"(?<![0-9])(?<![0-9][\x20-])(?=[0-9](?:[\x20-]?[0-9]){12})[0-9]++(?:[\x20-][0-9]++)*+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_SECRET = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{20,}+"
_VEILED = rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]++)+"

#: Top-level domains, issuer prefixes, country codes and names of secrets that the gazetteers know.
_DOMAINS = r"(?i)[.)\] ](com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at|us|ca|au|jp)$"
_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
_COUNTRIES = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_PRIVATE_NETS = r"^(0|10|127|169\.254|192\.168|22[4-9]|2[345][0-9])\."
_SECRET_NAMES = r"(?i)(token|secret|password|passwd|pwd|api_?key|access_?key|auth|credential)s?\W{0,6}$"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    quick: str  # a character or string without which there is no match
    context: str  # words before a span that speak for it
    known: str  # gazetteer, on the span or, for secrets, on what stands before
    base: bool


KINDS = [
    Kind("email", _EMAIL, "@", r"(?i)(e-?mail|contact|write|address|reply)\W{0,20}$", _DOMAINS, True),
    Kind("ip", _IP, ".", r"(?i)(ip|host|server|address|from|login)\W{0,20}$", _PRIVATE_NETS, True),
    Kind("card", _CARD, "", r"(?i)(card|visa|mastercard|credit|payment|pan)\W{0,20}$", _ISSUERS, True),
    Kind("phone", _PHONE, "+", r"(?i)(call|phone|tel|mobile|fax|whatsapp)\W{0,20}$", _COUNTRIES, True),
    Kind("secret", _SECRET, "", r"(?i)(\w+) ?[=:] ?[\"']?$", _SECRET_NAMES, False),
    Kind("veiled_email", _VEILED, "at", r"(?i)(e-?mail|contact|write|address|reply)\W{0,20}$", _DOMAINS, False),
]
CONTEXT_CHARS = 40


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    """Luhn's check of a string of digits."""
    n = F.length(d)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(d, n - i, F.lit(1)).cast("int")
        doubled = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 1, doubled).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _passes(kind: Kind, v: Column) -> Column:
    """The base check of a match; for the other kinds, the strict form."""
    if kind.name == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(v, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    if kind.name == "card":
        n = F.length(_digits(v))
        return F.when((n >= 13) & (n <= 19), _luhn(_digits(v))).otherwise(F.lit(False))
    if kind.name == "phone":
        return F.length(_digits(v)).between(9, 15)
    if kind.name == "secret":
        return v.rlike(r"^[0-9a-fA-F]{24,}$") | (v.rlike("[a-z]") & v.rlike("[A-Z]") & v.rlike("[0-9]"))
    return F.lit(True)


def _matches(text: Column, kind: Kind) -> Column:
    """Places, values and what stands before each match, in order."""
    return matches(text, kind.pattern, F.contains(text, F.lit(kind.quick)) if kind.quick else text.rlike("[0-9]"), before=CONTEXT_CHARS)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _candidate(k: int, kind: Kind):
    return lambda m: _voted(k, kind, m["s"], m["e"], m["v"], m["b"])


def _voted(k: int, kind: Kind, start: Column, end: Column, v: Column, b: Column) -> Column:
    ok = _passes(kind, v)
    known = (b if kind.name == "secret" else v).rlike(kind.known)
    gazetteer = _vote(~known, known) if kind.name == "ip" else _vote(known, F.lit(False) if kind.name == "secret" else ~known)
    context = _vote(b.rlike(kind.context), b.rlike(r"[A-Za-z0-9]$"))
    shape = F.least(F.floor(F.length(v) / 8), F.lit(4)).cast("int") * 2 + v.rlike("[A-Z]").cast("int")
    return F.struct(
        F.lit(k).alias("k"), start.alias("s"), end.alias("e"), (ok if kind.base else F.lit(False)).alias("base"),
        _vote(ok, ~ok).alias("regex"), gazetteer.alias("gazetteer"), context.alias("context"), shape.alias("shape"),
    )


_PATTERN = ["k", "regex", "gazetteer", "context", "shape"]


def candidates(documents: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``documents`` and ``__found``: every candidate span with its votes."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lists = [F.transform(_matches(t, kind), _candidate(k, kind)) for k, kind in enumerate(KINDS)]
    return documents.withColumn("__found", F.concat(*lists))


@dataclass
class SpanClassifier:
    """Weights by kind, and the reliabilities that expectation-maximisation found, for reports."""

    weights: np.ndarray
    reliability: dict[str, dict[str, float]]

    def accepts(self, c: Column) -> Column:
        z = F.lit(0.0)
        for j, x in enumerate(_feature_columns(c)):
            z = z + F.lit(float(self.weights[j])) * x
        return z >= 0


def _feature_columns(c: Column) -> list[Column]:
    out = [(c["k"] == k).cast("double") for k in range(len(KINDS))]
    for name in ("regex", "gazetteer", "context"):
        out += [(c[name] == v).cast("double") for v in (1, -1)]
    return out + [(c["shape"] == s).cast("double") for s in range(10)]


def _features(row: tuple) -> list[float]:
    k, *votes, shape = row
    out = [float(k == i) for i in range(len(KINDS))]
    for v in votes:
        out += [float(v == 1), float(v == -1)]
    return out + [float(shape == s) for s in range(10)]


def estimate(patterns: list[tuple], counts: list[int], rounds: int = 60) -> tuple[np.ndarray, dict]:
    """Expectation-maximisation over counted vote patterns: the chance that each is real, and each
    labeler's reliability (the chance that it speaks for a real span, and against one that isn't)."""
    votes, n = np.array([p[1:4] for p in patterns]), np.array(counts, float)
    kind = np.array([p[0] for p in patterns])
    chance = np.full(len(n), 0.5)
    report = {}
    for k in np.unique(kind):
        own = kind == k
        v, w = votes[own], n[own]
        p = _expit(1.5 * v.sum(axis=1))  # majority vote to start with
        hit = np.full((3, 2, 3), 1 / 3)
        for _ in range(rounds):
            share = ((w * p).sum() + 1) / (w.sum() + 2)
            for j in range(3):
                for c, q in enumerate((1 - p, p)):
                    for i, value in enumerate((-1, 0, 1)):
                        # A prior for labelers that are right more often than not.
                        lean = 2.0 if value == (1 if c else -1) else 0.5
                        hit[j, c, i] = (w * q)[v[:, j] == value].sum() + lean
                    hit[j, c] /= hit[j, c].sum()
            z = np.log(share / (1 - share)) + sum(np.log(hit[j, 1, v[:, j] + 1] / hit[j, 0, v[:, j] + 1]) for j in range(3))
            p = _expit(z)
        chance[own] = p
        report[KINDS[k].name] = {name: float((hit[j, 1, 2] + hit[j, 0, 0]) / 2) for j, name in enumerate(("regex", "gazetteer", "context"))}
    return chance, report


def _expit(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_classifier(found: DataFrame, rounds: int = 300, decay: float = 1e-3) -> SpanClassifier:
    """Count vote patterns over all rows, estimate, and train the span classifier on the counts."""
    size = len(_features((0, 0, 0, 0, 0)))
    rows = found.select(F.explode("__found").alias("c")).groupBy(*[F.col(f"c.{n}").alias(n) for n in _PATTERN]).count().collect()
    rows = sorted(tuple(r) for r in rows)
    if not rows:
        return SpanClassifier(np.where(np.arange(size) < len(KINDS), -1.0, 0.0), {})
    patterns, counts = [r[:5] for r in rows], [r[5] for r in rows]
    chance, report = estimate(patterns, counts)
    x, w = np.array([_features(p) for p in patterns]), np.sqrt(np.array(counts, float))
    w /= w.sum()
    b = np.zeros(size)
    for _ in range(rounds):  # Newton's steps, damped
        p = _expit(x @ b)
        gradient = x.T @ (w * (p - chance)) + decay * b
        curve = (x.T * (w * p * (1 - p))) @ x + decay * np.eye(size)
        move = np.linalg.solve(curve, gradient)
        b -= move * min(1, 2 / (1e-9 + np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return SpanClassifier(b, report)


def find_pii(documents: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``documents`` but the text, and ``__spans``: an array of (kind, start, end, base), by kind as
    listed, then start."""
    found = durable(candidates(documents, text).drop(text))
    model = fit_classifier(found)
    kept = F.filter("__found", lambda c: c["base"] | ((c["k"] >= sum(k.base for k in KINDS)) & model.accepts(c)))
    names = F.array(*[F.lit(k.name) for k in KINDS])
    order = F.array_sort(F.transform(kept, lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e"), c["base"].alias("base"))))
    spans = F.transform(order, lambda c: F.struct(F.element_at(names, c["k"] + 1).alias("kind"), c["s"].alias("start"), c["e"].alias("end"), c["base"].alias("base")))
    return found.withColumn("__spans", spans).drop("__found")


def op6_pii(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("__spans", lambda x: x["base"])
    kinds = F.transform("__spans", lambda x: x["kind"])
    count = {k: (F.size(kinds) - F.size(F.array_remove(kinds, k.name))).cast("long").alias(f"n_{k.name}") for k in KINDS}
    first, more = ([c for k, c in count.items() if k.base is kind] for kind in (True, False))
    return found.select("doc_id", *first, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"), *more)
