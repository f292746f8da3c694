"""Licence scan of paragraphs, with DataFrame functions only.

A paragraph (a non-blank line) is classified by multinomial logistic regression on its word 1- and 2-grams
into a licence family, ``unknown`` (text under a licence of no known family) or none, which ordinary prose about licences is too. It is trained on the
driver on sentences built from the templates below and on a bounded sample of the corpus's own paragraphs
as examples of none. A temperature fitted on sentences kept apart calibrates the probabilities. A predicted
family is confirmed by comparison with its templates: enough of one template's words must occur in the
paragraph. A family that isn't confirmed, or whose calibrated probability is below ``threshold``, is
``unknown``.

A notice may be wrapped: where a line alone has no confirmed family, it is classified together with the lines
after it, up to a blank line or a line with a confirmed family of its own, and up to twice the words of the longest template. The
fewest lines that confirm a family are one hit, numbered by the first of them; they give no other hits.

The weights are few (the features are the n-grams of the templates that are rare in the corpus) and are a
literal of the query, so scoring happens where the text is: no join, no shuffle. Only paragraphs that
contain one of the features' words are scored; all others have no feature and so the class none.

Defined cases: null and empty texts have no paragraphs; repeated rows each get their row; paragraphs of any
length are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence families, the names they go by, and sentences of their notices.
FAMILIES = {
    "MIT": (["MIT License", "MIT licence", "X11 MIT License", "Expat License"], ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"]),
    "Apache-2.0": (["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0"], ["you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"]),
    "GPL": (["GNU General Public License, version 3", "GNU General Public License version 2", "GNU GPL v3", "GPLv3", "GPL-2.0-or-later"], ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"]),
    "LGPL": (["GNU Lesser General Public License, version 3", "GNU Lesser General Public License version 2.1", "LGPL-3.0", "GNU LGPL"], ["this library is free software under the terms of the gnu lesser general public license"]),
    "AGPL": (["GNU Affero General Public License, version 3", "AGPL-3.0", "GNU AGPL v3"], ["under the terms of the gnu affero general public license as published by the free software foundation"]),
    "BSD": (["BSD 3-Clause License", "BSD 2-Clause License", "BSD license", "New BSD License"], ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"]),
    "MPL": (["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"], ["this source code form is subject to the terms of the mozilla public license"]),
    "CC-BY-NC": (["CC BY-NC 4.0", "CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"], ["licensed under a creative commons attribution noncommercial license"]),
    "CC-BY": (["CC BY 4.0", "CC BY-SA 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution-ShareAlike 3.0 License"], ["licensed under a creative commons attribution license"]),
    "CC0": (["CC0 1.0", "CC0 1.0 Universal Public Domain Dedication"], ["dedicated to the public domain under cc0"]),
}
PHRASES = ["licensed under {}", "licensed under the {}", "released under the {}", "released under {}", "this work is licensed under the {}", "distributed under the terms of the {}", "available under the {}", "this software is licensed under the {}", "see the {} for details", "spdx license identifier {}", "license {}", "{}"]
OTHERS = ["Example Corp Proprietary License", "Acme End User License Agreement", "Foo Bar License 1.1", "Zeta Community License", "Evaluation License", "Commercial License", "Custom License 2024", "vendor licence terms"]
#: Ordinary prose that names licences, as examples of none.
ORDINARY = [
    "your driver's license has expired", "she lost her driving licence last year", "he applied for a fishing license", "a license for the dog costs ten dollars", "the pilot kept her licence",
    "they need a marriage license first", "the bar lost its liquor licence", "a licensed practitioner must sign here", "poetic licence explains the rest", "the television licence fee rose again", "he was licensed to practise medicine",
    "bring your license and registration", "the hunting license must be renewed each year", "the state licensing board met today", "drivers without a license were fined", "the club holds a gaming license", "the nurse renewed her license", "license plates were stolen",
]
NONE, UNKNOWN = "none", "unknown"
CLASSES = [NONE, UNKNOWN, *FAMILIES]


def words_of(text: str) -> list[str]:
    return [w for w in re.sub(r"[^\x00-\x7f]", " ", text).lower().replace("'", " ").translate(_TO_SPACE).split(" ") if w]


_TO_SPACE = {i: " " for i in range(128) if not chr(i).isalnum()}


def grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


@dataclass
class LicenceModel:
    weights: dict[str, list[float]]  # n-gram to a weight per class
    bias: list[float]
    temperature: float
    threshold: float
    templates: dict[str, list[list[str]]]


def _sentences() -> list[tuple[str, str]]:
    out = []
    for family, (names, notices) in FAMILIES.items():
        out += [(p.format(n), family) for n in names for p in PHRASES]
        out += [(n, family) for n in notices for _ in range(4)]
    return out + [(p.format(n), UNKNOWN) for n in OTHERS for p in PHRASES] + [(s, NONE) for s in ORDINARY for _ in range(6)]


def fit_licences(documents: DataFrame, text: str = "text", sample_paragraphs: int = 5000, threshold: float = 0.6, rounds: int = 400) -> LicenceModel:
    """Train on the templates and on ``sample_paragraphs`` different paragraphs of the corpus with the smallest
    hashes. Which words are rare is counted over all paragraphs. Those that name a licence themselves are left
    out of both. Of a paragraph of any length, only the templates' n-grams come to the driver."""
    made = _sentences()
    # Of ordinary prose, only pairs with a word for licences are features: more of them would make more paragraphs worth scoring.
    names = {g for s, _ in made for g in grams(words_of(s)) if s not in ORDINARY or (" " in g and "licen" in g)}
    t = F.col(text).cast("string")
    lines = documents.where(t.isNotNull()).select(F.explode(F.split(t, "\n")).alias("line"))
    lines = lines.where((F.trim("line") != "") & ~F.col("line").rlike("(?i)licen[sc]"))
    words = F.array(*[F.lit(g) for g in sorted(names) if " " not in g])
    # A null stands for the paragraph itself.
    seen = lines.select(F.explode(F.concat(F.array_intersect(_split_words(F.col("line")), words), F.array(F.lit(None).cast("string")))).alias("w"))
    often = {r[0]: r[1] for r in seen.groupBy("w").count().collect()}
    total = often.pop(None, 0)
    # Hashes first, so that no task gathers texts; the largest chosen one then tells which paragraphs to take.
    hashed = lines.withColumn("h", F.xxhash64("line"))
    last = hashed.select("h").distinct().orderBy("h").limit(max(1, sample_paragraphs)).agg(F.max("h")).first()[0]
    chosen = hashed.where(F.col("h") <= (last if last is not None else 0))
    known = F.from_json(F.lit(json.dumps(sorted(names))), "array<string>")
    grams_in = chosen.select("h", F.array_intersect(_let(_words(F.col("line")), _grams), known).alias("g")).dropDuplicates(["h"])
    corpus = [set(r[1]) for r in sorted(grams_in.collect(), key=lambda r: r[0])]
    # A feature must be rare in the corpus: at most one in five hundred of its paragraphs.
    # A pair of words counts only if one of the two is a feature itself, so that paragraphs can be told by words.
    single = {g for g in names if " " not in g and often.get(g, 0) * 500 <= total and any(c.isalpha() for c in g) and len(g) > 1}
    features = sorted(single | {g for g in names if " " in g and single & set(g.split(" "))})
    place = {g: i for i, g in enumerate(features)}
    examples = [(grams(words_of(s)), CLASSES.index(c)) for s, c in made]
    # Most paragraphs of the corpus have no feature at all; they all are one weighted example.
    own = [g for g in (w & place.keys() for w in corpus) if g]
    examples += [(g, 0) for g in own] + [(set(), 0)] * 50
    apart = np.arange(len(examples)) % 7 == 3
    x = np.zeros((len(examples), len(features)))
    for i, (g, _) in enumerate(examples):
        x[i, [place[f] for f in g if f in place]] = 1
    y = np.eye(len(CLASSES))[[c for _, c in examples]]
    w, b = np.zeros((len(features), len(CLASSES))), np.zeros(len(CLASSES))
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    xt, yt = x[~apart], y[~apart]
    for _ in range(rounds):
        d = (_softmax(xt @ w + b) - yt) / len(xt)
        speed_w = 0.9 * speed_w - 2.0 * (xt.T @ d + 1e-4 * w)
        speed_b = 0.9 * speed_b - 2.0 * d.sum(axis=0)
        w, b = w + speed_w, b + speed_b
    z, t = x[apart] @ w + b, y[apart].argmax(axis=1)
    loss = lambda heat: -np.log(_softmax(z / heat)[np.arange(len(z)), t] + 1e-12).mean()
    heat = min(np.geomspace(0.3, 4, 40), key=loss)
    templates = {f: [sorted(set(words_of(s))) for s in [*n, *notices]] for f, (n, notices) in FAMILIES.items()}
    weights = {g: [round(float(v), 5) for v in w[i]] for g, i in place.items()}
    return LicenceModel(weights, [round(float(v), 5) for v in b], float(heat), threshold, templates)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _split_words(p: Column) -> Column:
    return F.split(F.lower(p), "[^0-9a-z]+")


def _words(p: Column) -> Column:
    return F.filter(_split_words(p), lambda w: w != "")


def _grams(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.array_distinct(F.concat(words, pairs))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _classify(p: Column, model: LicenceModel) -> Column:
    """(family, probability, similarity) of a paragraph."""
    table = F.from_json(F.lit(json.dumps(model.weights)), "map<string,array<double>>")
    templates = F.from_json(F.lit(json.dumps(model.templates)), "map<string,array<array<string>>>")

    def of_words(words: Column) -> Column:
        rows = F.filter(F.transform(_grams(words), lambda g: F.element_at(table, g)), lambda row: row.isNotNull())
        z = F.aggregate(rows, F.array(*[F.lit(v) for v in model.bias]), lambda acc, row: F.zip_with(acc, row, lambda a, b: a + b))
        return _let(z, lambda z: _let(F.array_max(z), lambda top: of_scores(F.transform(z, lambda v: F.exp((v - top) / F.lit(model.temperature))), words)))

    def of_scores(scores: Column, words: Column) -> Column:
        best = F.array_max(F.transform(scores, lambda v, i: F.struct(v.alias("p"), (-i).alias("i"))))
        total = F.aggregate(scores, F.lit(0.0), lambda s, q: s + q)
        name = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), 1 - best["i"])
        return _let(F.struct(name.alias("name"), (best["p"] / total).alias("p")), lambda b: confirmed(b["name"], b["p"], words))

    def confirmed(name: Column, p: Column, words: Column) -> Column:
        inside = F.transform(F.element_at(templates, name), lambda t: F.size(F.array_intersect(t, words)) / F.size(t))
        return _let(F.coalesce(F.array_max(inside), F.lit(0.0)), lambda similarity: F.struct(
            F.when(name == NONE, F.lit(NONE)).when((p >= model.threshold) & (similarity >= 0.75), name).otherwise(F.lit(UNKNOWN)).alias("family"),
            F.round(p, 6).alias("probability"), F.round(similarity, 6).alias("similarity"),
        ))

    return _let(_words(p), of_words)


def _confirmed(family: Column) -> Column:
    return ~family.isin(NONE, UNKNOWN)


def _notice(lines: Column, judged: Column, sure: Column, r: Column, model: LicenceModel) -> Column:
    """(last, c, text) of the wrapped notice that begins at line ``r.i``, or null."""
    every = [t for own in model.templates.values() for t in own]
    most = 2 * max((len(t) for t in every), default=0)
    known = F.from_json(F.lit(json.dumps(every)), "array<array<string>>")
    joined = lambda first, last: F.array_join(F.slice(lines, first + 1, last - first + 1), "\n")

    def take(state: Column, x: Column) -> Column:
        goes_on = state["open"] & (state["n"] < most) & x.rlike(r"\S") & ~F.array_contains(sure, state["last"] + 1)
        return F.when(goes_on, F.struct((state["last"] + 1).alias("last"), (state["n"] + F.size(_words(x))).alias("n"), F.lit(True).alias("open"))).otherwise(F.struct(state["last"].alias("last"), state["n"].alias("n"), F.lit(False).alias("open")))

    def of_reach(last: Column) -> Column:
        # No part of these lines can be like a template if all of them are not.
        like = _let(_words(joined(r["i"], last)), lambda words: F.exists(known, lambda t: F.size(F.array_intersect(t, words)) >= 0.75 * F.size(t)))
        return F.when((last > r["i"]) & like, shortest(last))

    def shortest(last: Column) -> Column:
        parts = F.transform(F.sequence(r["i"] + 1, last), lambda j: F.struct(j.alias("last"), _classify(joined(r["i"], j), model).alias("c"), joined(r["i"], j).alias("text")))
        return _let(F.get(F.filter(parts, lambda x: _confirmed(x["c"]["family"])), F.lit(0)), lambda x: F.when(x.isNotNull() & ~later(x), x))

    def later(x: Column) -> Column:
        """Whether a later line begins the same notice, so that this one stands before it."""
        inner = F.filter(judged, lambda s: (s["i"] > r["i"]) & (s["i"] < x["last"]))
        return F.exists(inner, lambda s: _confirmed(_classify(joined(s["i"], x["last"]), model)["family"]))

    start = F.struct(r["i"].alias("last"), F.size(_words(r["x"])).alias("n"), F.lit(True).alias("open"))
    return _let(F.aggregate(F.slice(lines, r["i"] + 2, most), start, take)["last"], of_reach)


def _feature_words(model: LicenceModel) -> str:
    """A pattern for the single words among the features; each other feature holds one of them."""
    return r"(?i)(?<![0-9a-z])(?:" + "|".join(sorted(g for g in model.weights if " " not in g)) + r")(?![0-9a-z])"


def scan_licences(documents: DataFrame, model: LicenceModel, text: str = "text") -> DataFrame:
    """All columns of ``documents``, ``__n_paragraphs`` and ``__hits``: an array of (paragraph, family,
    probability, similarity, text), paragraphs numbered from 0 among all lines, a wrapped notice by its first."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.split(t, "\n")
    some = _feature_words(model)
    numbered = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda r: r["x"].rlike(some))

    kind = "array<struct<paragraph:int,family:string,probability:double,similarity:double,text:string>>"

    def hit(i: Column, c: Column, x: Column) -> Column:
        return F.array(F.struct(i.alias("paragraph"), c["family"].alias("family"), c["probability"].alias("probability"), c["similarity"].alias("similarity"), x.alias("text")))

    def step(state: Column, r: Column) -> Column:
        own, notice = hit(r["i"], r["c"], r["x"]), r["notice"]
        whole = F.struct(F.concat(state["hits"], hit(r["i"], notice["c"], notice["text"])).alias("hits"), notice["last"].alias("last"))
        with_own = F.struct(F.concat(state["hits"], own).alias("hits"), state["last"].alias("last"))
        sure = _confirmed(r["c"]["family"])
        return F.when(sure, with_own).when(r["i"] <= state["last"], state).when(notice.isNotNull(), whole).when(r["c"]["family"] != NONE, with_own).otherwise(state)

    def of_judged(judged: Column) -> Column:
        return _let(F.transform(F.filter(judged, lambda r: _confirmed(r["c"]["family"])), lambda r: r["i"]), lambda sure: of_sure(judged, sure))

    def of_sure(judged: Column, sure: Column) -> Column:
        noticed = F.transform(judged, lambda r: F.struct(r["i"].alias("i"), r["x"].alias("x"), r["c"].alias("c"), F.when(~_confirmed(r["c"]["family"]), _notice(lines, judged, sure, r, model)).alias("notice")))
        start = F.struct(F.array().cast(kind).alias("hits"), F.lit(-1).alias("last"))
        return F.aggregate(noticed, start, step)["hits"]

    hits = _let(F.transform(numbered, lambda r: F.struct(r["i"].alias("i"), r["x"].alias("x"), _classify(r["x"], model).alias("c"))), of_judged)
    empty = F.array().cast(kind)
    blank = F.size(F.filter(lines, lambda x: F.trim(x) == ""))
    return documents.withColumns({"__n_paragraphs": (F.size(lines) - blank).cast("long"), "__hits": F.when(t.rlike(some), hits).otherwise(empty)})


def op7_licences(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = F.col("__hits")
    return scan_licences(docs, fit_licences(docs)).select(
        "doc_id",
        F.col("__n_paragraphs").alias("n_paragraphs"),
        F.size(hits).cast("long").alias("n_licence"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["family"]))), ",").alias("families"),
        F.array_max(F.transform(hits, lambda h: h["probability"])).alias("probability"),
        F.array_join(F.transform(hits, lambda h: F.concat_ws(":", h["paragraph"].cast("string"), h["family"])), ",").alias("paragraphs"),
    )
