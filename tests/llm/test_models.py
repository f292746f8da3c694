"""Classifiers by held-out accuracy, personal data and pages against brute force, and the pipeline."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lessonweave.llm import html_extract, licences, pii, quality, toxicity

SF = "/root/testdata/sf0.01"
ODD = [(None, None), (1, ""), (2, "x" * 300_000), (3, "same"), (3, "same"), (4, "é𝑈\n")]


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "pages", "benchmark")}


def auc(label, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1 = int(label.sum())
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_quality_held_out(spark, tables):
    got = quality.op4_quality(spark, SF).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda x: zlib.crc32(str(x).encode()) % 5 == 0)).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    both = got[got.held_out].merge(tables["labels"].toPandas(), on="doc_id")
    assert auc(both.quality.to_numpy(), both.score.to_numpy()) > 0.95


def test_quality_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "c") for i, t in ODD], "doc_id long, text string, score string")
    net = quality.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    rows = quality.score_quality(docs, net).collect()
    assert len(rows) == len(ODD) and {round(r["__score"], 6) for r in rows} == {0.5}
    assert quality.score_quality(docs.limit(0), net).count() == 0


def test_chunks_cover_all_bytes():
    for n in (0, 1, 251, 252, 253, 480, 492, 493, 5000):
        x, row = quality.chunks(np.arange(n).astype(np.uint8), np.array([0, n]))
        assert row.max() == len(x) - 1 - (len(x) - 1) or set(row) == {0}
        assert len(x) * quality.STEP + quality.WIDTH >= n


def test_toxicity_held_out(spark, tables):
    got = toxicity.op10_toxicity(spark, SF).toPandas().merge(tables["labels"].toPandas().rename(columns={"toxic": "label"}), on="doc_id")
    clean, bad = got[got.label == 0], got[got.label == 1]
    assert clean.toxic.mean() < 0.02 and bad.toxic.mean() > 0.6
    assert bad.severity.mean() > clean.severity.mean() + 0.8 and got.severity.between(0, 3).all()
    model = toxicity.fit_severity(tables["documents"], tables["labels"])
    assert (np.diff(model.thresholds) > 0).all()


def test_toxicity_on_odd_rows(spark, tables):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ODD], "doc_id long, text string, grade int")
    model = toxicity.fit_severity(tables["documents"], tables["labels"])
    rows = toxicity.grade_toxicity(docs, model).collect()
    assert len(rows) == len(ODD) and max(r["__p_over_0"] for r in rows) < 0.5
    assert toxicity.grade_toxicity(docs, toxicity.train([], [])).where("__p_over_0 > 0").count() == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum((2 * int(c) - 9 * (c > "4")) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_are_exact(spark, tables):
    rng = random.Random(3)
    texts = ["".join(rng.choice("a1.@+- ()bZ09é𝑈\n%_[at]4") for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    texts += [None, "", "a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "4111-1111 1111 1111", "1" * 5000, "a" * 100_000 + "@", "b." * 20_000 + "c@" + "d." * 20_000 + "e", "0" * 40 + "1.1.1.1", 'token = "dfd1944d2e84f15e89902e34b677eb5a"']
    texts += [r["text"] for r in tables["documents"].select("text").collect()]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(4)
    found = pii.find_pii(docs)
    rows = {r["doc_id"]: r for r in found.select("doc_id", "spans", pii.joined(F.filter("__spans", lambda x: x["base"])).alias("base"), pii.joined(F.col("__spans")).alias("every")).collect()}
    assert {i: r["base"] for i, r in rows.items()} == {i: brute_pii(t) for i, t in enumerate(texts)}
    assert all(set(r["base"].split(",")) <= set(r["every"].split(",")) | {""} for r in rows.values())
    assert "secret:9:41" in rows[texts.index('token = "dfd1944d2e84f15e89902e34b677eb5a"')]["every"]
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_pii_digest(spark, tables):
    got = {r["doc_id"]: r for r in pii.op6_pii(spark, SF).collect()}
    for r in tables["documents"].limit(200).collect():
        base = brute_pii(r["text"])
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert got[r["doc_id"]]["n_email"] == base.count("email:")


def test_em_finds_the_reliable_labeler():
    rng = random.Random(1)
    counts = {}
    for _ in range(5000):
        real = rng.random() < 0.4
        vote = lambda p: (1 if real else -1) if rng.random() < p else (-1 if real else 1)
        key = (0, vote(0.95), vote(0.8), vote(0.6), 0)
        counts[key] = counts.get(key, 0) + 1
    _, report = pii.estimate(list(counts), list(counts.values()))
    r = report["email"]
    assert r["regex"] > r["gazetteer"] > r["context"] > 0.5


def test_licences(spark, tables):
    model = licences.fit_licences(tables["documents"])
    rows = [(1, "Some prose here.\nReleased under the MIT License.\n\nmore"), (2, "Licensed under the Quux Public Terms License."), (3, None), (4, ""), (5, "the end " * 30_000), (6, "Licensed under CC BY-NC 4.0."), (6, "Licensed under CC BY-NC 4.0.")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, family string")
    got = [(r["doc_id"], [(h["paragraph"], h["family"]) for h in r["__hits"]]) for r in licences.scan_licences(docs, model).orderBy("doc_id").collect()]
    assert got == [(1, [(1, "MIT")]), (2, [(0, "unknown")]), (3, []), (4, []), (5, []), (6, [(0, "CC-BY-NC")]), (6, [(0, "CC-BY-NC")])]
    truth = {"MIT": "MIT License", "Apache-2.0": "Apache License", "GPL": "GNU General Public", "CC-BY-NC": "CC BY-NC"}
    texts = {r["doc_id"]: r["text"] for r in tables["documents"].collect()}
    for r in licences.op7_licences(spark, SF).collect():
        assert r["families"] == ",".join(sorted(k for k, v in truth.items() if v in texts[r["doc_id"]]))
    assert licences.fit_licences(docs.limit(0)).weights and licences.scan_licences(docs.limit(0), model).count() == 0


def test_licence_features_are_counted_in_all_paragraphs(spark):
    # "zeta" and "foo" stand in one paragraph of ten, but in none of a text's five last ones by alphabet.
    rows = [(i, "\n".join(["a zeta line " + str(i), "w " * 500 + "foo", *(f"z{k} words {i}" for k in range(8))])) for i in range(300)]
    model = licences.fit_licences(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), sample_paragraphs=50)
    assert not {"zeta", "foo"} & set(model.weights) and {"mozilla", "bar"} <= set(model.weights)


def test_ordinary_prose_about_licences_is_none(spark, tables):
    model = licences.fit_licences(tables["documents"])
    prose = ["Your driving license must be renewed each year.", "She bought a license for her dog.", "The pilot lost his licence in May."]
    real = ["Covered by the Foo Community License 3.", "Licensed under the terms of the Acme Corp License Agreement."]
    docs = spark.createDataFrame(list(enumerate(prose + real)), "doc_id long, text string")
    got = {r["doc_id"]: [h["family"] for h in r["__hits"]] for r in licences.scan_licences(docs, model).collect()}
    assert got == {0: [], 1: [], 2: [], 3: ["unknown"], 4: ["unknown"]}


def test_wrapped_notices_have_their_family(spark, tables):
    model = licences.fit_licences(tables["documents"])
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the Software)."
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    rows = [(1, mit), (2, "Some prose.\n\n" + bsd), (3, mit.replace("\n", "\n\n")), (4, "Plain words stand here.\nThis work is licensed under the GNU Affero General\nPublic License, version 3\nand ends."), (5, "Released under the MIT License.\n" + bsd), (6, mit.replace(" ", "\n"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(h["paragraph"], h["family"]) for h in r["__hits"] if h["family"] != "unknown"] for r in licences.scan_licences(docs, model).collect()}
    assert got == {1: [(0, "MIT")], 2: [(2, "BSD")], 3: [], 4: [(1, "AGPL")], 5: [(0, "MIT"), (1, "BSD")], 6: got[6]}
    assert [f for _, f in got[6]] == ["MIT"]


def test_main_text_of_all_pages(spark, tables):
    got = {r["page_id"]: r["text"] for r in html_extract.op3_html(spark, SF).collect()}
    for r in tables["pages"].collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        inner = re.sub(r"</?(?:p|h\d|br|div|li|ul)[^>]*>", " ", inner)
        assert got[r["page_id"]] == " ".join(html.unescape(re.sub("<[^>]*>", "", inner)).split())


def test_other_templates(spark):
    page = lambda k, main: f"<html><body><header>Site</header><ul class='menu'><li><a href=x>Home</a></ul><div id=content><h2>Title {k}</h2>{main}<div class='share'>Share this</div></div><div class=sidebar>Old news</div><form>Name<input></form><section id=comments><p>Nice!</section><footer>&copy; me</footer><script>if (a<b) x('</p>')</script></body>"
    rows = [(k, f"http://h.example/{k}", page(k, f"<p>Text&nbsp;{k} &amp; <b>bo</b>ld<p>two{k}<br>lines " + "words " * k)) for k in range(6)] + [(90, None, None), (91, "", ""), (92, "http://z", "<p>plain <article>in<!-- no --> side"), (92, "http://z", "<p>plain <article>in<!-- no --> side")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string")
    for most in (10**6, -1):
        html_extract.SMALL_TOKENS, before = most, html_extract.SMALL_TOKENS
        got = sorted((r["page_id"], r["__text"]) for r in html_extract.extract_text(df).collect())
        html_extract.SMALL_TOKENS = before
        assert got == [(k, " ".join(f"Title {k} Text {k} & bold two{k} lines {'words ' * k}".split())) for k in range(6)] + [(90, ""), (91, ""), (92, "in side"), (92, "in side")]
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_long_and_linked_template_text_goes(spark):
    notice = "<p>We use <b>small</b> files. <a href=/more>More</a></p>"
    legal = "<p>" + "All rights of this site are with its owner and with nobody else. " * 6 + "</p>"
    page = lambda k: f"<html><body><div id=content><h2>Title {k}</h2>{notice}<p>Own <a href=x>words</a> of page {k} {'and more ' * 40}</p>{legal}</div></body></html>"
    df = spark.createDataFrame([(k, f"http://h.example/{k}", page(k)) for k in range(6)], "page_id long, url string, html string")
    got = {r["page_id"]: r["__text"] for r in html_extract.extract_text(df).collect()}
    assert got == {k: f"Title {k} Own words of page {k} {'and more ' * 40}".strip() for k in range(6)}


def test_scores_are_those_of_a_plain_loop():
    """The network's forward pass and the cumulative-link model, value by value in plain Python."""
    rng = np.random.default_rng(4)
    net = quality.train(["good words here " * 40, "bad#bad#" * 50, "fine text " * 30, "##" * 90] * 3, [1, 0, 1, 0] * 3, steps=20)
    texts = ["", "short", "a longer text of words " * 60, bytes(rng.integers(32, 127, 1000).astype(np.uint8)).decode()]
    data, offsets = quality.flat_text(pa.array(texts))
    for text, score in zip(texts, quality.score_rows(net, data, offsets), strict=True):
        raw, pooled = text.encode(), []
        for at in range(0, max(1, len(raw) - quality.WIDTH), quality.STEP) if len(raw) > quality.WIDTH else [0]:
            chunk = (raw[at : at + quality.CHUNK] + bytes(quality.CHUNK))[: quality.CHUNK]
            values = []
            for f in range(quality.FILTERS):
                windows = range(0, quality.WINDOWS * quality.HOP, quality.HOP)
                best = max(sum(float(net.embed[chunk[w + i], j]) * float(net.filters[i * quality.DIM + j, f]) for i in range(quality.WIDTH) for j in range(quality.DIM)) for w in windows)
                values.append(max(0.0, best + float(net.bias[f])))
            pooled.append(values)
        z = float(net.offset[0]) + sum(float(net.mean_w[f]) * sum(p[f] for p in pooled) / len(pooled) + float(net.max_w[f]) * max(p[f] for p in pooled) for f in range(quality.FILTERS))
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-4
    model = toxicity.train(["you fool and clown"] * 9 + ["kind words for you"] * 9, [1] * 9 + [0] * 9)
    known = {w: toxicity.hash_words(toxicity.find_words(*quality.flat_text(pa.array([w]))))[0] for w in "you fool and clown kind words for".split()}
    place = {int(h): i for i, h in enumerate(model.words)}
    for text in ("fool fool clown", "kind", "", "Fool, you!"):
        counts = {}
        for w in re.findall("[a-z]+", text.lower()):
            counts[w] = counts.get(w, 0) + 1
        z = sum(float(model.weight[place[int(known[w])]]) * np.log1p(n) for w, n in counts.items() if int(known[w]) in place)
        want = [1 / (1 + np.exp(t - z)) for t in model.thresholds]
        data, offsets = quality.flat_text(pa.array([text]))
        assert np.allclose(model.exceed(data, offsets)[0], want) and list(want) == sorted(want, reverse=True)


def pages_of(spark, *pages):
    return spark.createDataFrame([(k, f"http://h.example/{k}", p) for k, p in enumerate(pages)], "page_id long, url string, html string")


def texts_of(df):
    return [r["__text"] for r in sorted(html_extract.extract_text(df).collect(), key=lambda r: r["page_id"])]


def test_the_template_decides_without_names(spark, monkeypatch):
    """No name tells the menu, the notice, the related links or the legal text apart, in an article or out of it."""
    links = lambda k: "".join(f"<li><a href=/{k}{i}>Read {k} {i} next</a></li>" for i in range(5))
    notice = "<div><p>We use <b>small</b> files on this site. <a href=/x>More</a></p></div>"
    own = lambda k: f"<h1>Title {k}</h1><p>Own text <a href=q>of</a> page {k}: {'more words ' * 30}</p><p>End {k}.</p>"
    page = lambda k: f"<html><body><div><span>Site of words</span></div><article>{notice}{own(k)}<ul>{links(k)}</ul><div><i>All rights are kept.</i></div></article><div><p>Aside {k} of it</p></div></body></html>"
    want = [f"Title {k} Own text of page {k}: {'more words ' * 30}End {k}." for k in range(8)]
    assert texts_of(pages_of(spark, *map(page, range(8)))) == want
    assert texts_of(pages_of(spark, *map(page, range(8)), *map(page, range(8)))) == want * 2  # repeated pages
    with_names = texts_of(pages_of(spark, *map(page, range(8))))
    monkeypatch.setattr(html_extract, "LEAST_PAGES", 10**6)
    assert texts_of(pages_of(spark, *map(page, range(8)))) != with_names  # what goes, goes by the template
    assert texts_of(pages_of(spark, *[page(1)] * 5)) == texts_of(pages_of(spark, page(1))) * 5


def test_copies_of_one_article_keep_their_text(spark):
    page = lambda k: f"<body><p>Menu</p><article><p>The same long text stands on all of these pages, word for word.</p></article><p>{k}</p></body>"
    assert set(texts_of(pages_of(spark, *map(page, range(6))))) == {"The same long text stands on all of these pages, word for word."}


@pytest.mark.parametrize("html, want", [
    ("<article><p data-x=it's>Hello one</p><p>World don't go</p></article>", "Hello one World don't go"),
    ('<article><p title="a>Hello</p><p class="x">there</p></article>', "Hello there"),
    ('<article><p>One</p><div class="related-work"><p>Two</p></div><div class="related-posts">No</div></article>', "One Two"),
    ("<div class=search><main><p>Kept</p></main></div>", "Kept"),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><button>Buy</button></article>", "Let x=1 be."),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ("<article><p>" + "word " * 200_000 + "</p></article>", ("word " * 200_000).strip()),
    ('<p a="1>2">x &lt; y', "x < y"),
    ("<aside><article>Teaser</article></aside><article>Main</article>", "Main"),
])
def test_odd_html(html, want):
    assert html_extract.main_text(html, None) == want


def test_pipeline_stages(spark, tables, tmp_path):
    docs = tables["documents"]
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs_after = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs_after.columns == tables["documents"].columns
            after = {r["doc_id"]: r for r in docs_after.collect()}
            assert set(after) <= set(before) and (name == "line_dedup" or all(after[i] == before[i] for i in after))
            kept[name] = set(after)
        else:
            assert {r["doc_id"] for r in docs_after.collect()} == set(before)
        docs = docs_after
    labels = tables["labels"].toPandas()
    good = set(labels[labels.quality == 1].doc_id)
    assert len(kept["quality"] & good) > 0.97 * len(good)
    assert len(kept["quality"] & set(labels[labels.quality == 0].doc_id)) < 0.25 * (labels.quality == 0).sum()
