"""Secrets in texts, with DataFrame functions only: patterns, and two character Markov models.

Three base kinds come from patterns. Besides them, every run of at least ``LEAST`` letters, digits and ``+/_-`` with a
letter and ``DIFFERENT`` different characters is a candidate. One first-order model of characters is trained on random strings, one on ordinary identifiers; a
candidate is a secret where the ratio of its likelihoods under them is high enough. Labelled samples are the
values that the base patterns found (random) and the words of a bounded sample of documents (ordinary), beside
generated ones of both sorts, so that a corpus without secrets has models too. The margin is the larger of the
odds against a candidate being a secret and what nearly all ordinary samples stay below.

Positions are code points, ends exclusive. All steps take linear time in a text's length.

Defined cases: a null text is empty and has no spans; repeated rows each get their row; columns whose names begin
with two underscores are this module's own, all others pass through; candidates that touch a base span are left out, as the
base has them; without documents, the generated samples are the training set.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.common import durable
from lessonweave.llm.spans import bound, joined, matches, running

BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "random"]
_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Matches of these two reach to the end of their run, so that short ones can be left out by the pattern.
_ACCESS = r"AKIA[A-Z0-9]{16,}+"
_HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
LEAST = 16
_RUN = rf"(?<![A-Za-z0-9+/_-])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{{{LEAST},}}+={{0,2}}"
#: Runs of fewer different characters are rulers and laughter.
DIFFERENT = 8

#: Characters by code: ``+`` to ``z``; a pair's index is that of its first times their number, plus that of its second.
_FIRST, _SIZE = ord("+"), ord("z") - ord("+") + 1
#: Samples that count as labelled: so many documents, and characters of each, and values of base spans.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_VALUES = 4_000, 65_536, 20_000
GENERATED = 2_000
#: Odds of a thousand to one against; the share of ordinary samples below the margin.
ODDS, BELOW = float(np.log(1000)), 0.9999

#: Stems of the generated identifiers.
STEMS = "account action address array base buffer build cache call class client code column config context control count data date default delete device document element error event field file filter find format handler header image index input item key label layer length level line list load local log manager message method model module name node number object option output page param parent parse path payment point port process profile query range record release remote request response result route sample schema script search section select server session setting size source start state status stream string style table target task template test text thread time title type update user value version view window".split()


def candidates(documents: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``documents``, ``__base`` (kind, start, end, value) of the base kinds by start, then kind, and ``__runs``
    (start, end, value) of all other candidates."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    assign = F.filter(matches(t, _ASSIGN, t.rlike("[:=]"), group=2), lambda m: F.length(m["g"]) >= 6)
    found = [assign, matches(t, _ACCESS, F.contains(t, F.lit("AKIA"))), matches(t, _HEX, t.rlike("[0-9a-f]{24}"))]
    span = lambda k: lambda m: F.struct(m["s"].alias("start"), F.lit(k).alias("k"), m["e"].alias("end"), F.coalesce(m["g"], m["v"]).alias("value"))
    kept = [F.transform(own, span(k)) for k, own in enumerate(found)]
    base = documents.withColumn("__base", F.array_sort(F.concat(*kept)))
    runs = F.transform(matches(t, _RUN, t.rlike(f"[A-Za-z0-9+/_-]{{{LEAST}}}")), lambda m: F.struct(m["s"].alias("start"), m["e"].alias("end"), m["v"].alias("value")))
    various = F.filter(runs, lambda x: _various(x["value"]))
    return base.withColumn("__runs", _apart(various, F.col("__base")))


def _various(value: Column) -> Column:
    return F.size(F.array_distinct(F.regexp_extract_all(value, F.lit("."), F.lit(0)))) >= DIFFERENT


def _apart(runs: Column, base: Column) -> Column:
    """The runs that touch no base span: none that began before reaches into them, and none begins within."""
    item = lambda run: lambda x: F.struct(x["start"].alias("start"), F.lit(run).alias("run"), x["end"].alias("end"), x["value"].alias("value"))
    in_order = lambda r: F.array_sort(F.concat(F.transform(base, item(0)), F.transform(r, item(1))))

    def apart(both: Column) -> Column:
        reached = running(F.transform(both, lambda x: F.when(x["run"] == 0, x["end"]).otherwise(0)), lambda a, b: F.greatest(a, b))

        def kept(reached: Column) -> Column:
            near = lambda x, i: F.coalesce(F.get(reached, i) > x["start"], F.lit(False)) | F.coalesce((F.get(both, i + 1)["run"] == 0) & (F.get(both, i + 1)["start"] < x["end"]), F.lit(False))
            marked = F.transform(both, lambda x, i: F.struct(x.alias("x"), near(x, i).alias("near")))
            return F.transform(F.filter(marked, lambda m: (m["x"]["run"] == 1) & ~m["near"]), lambda m: F.struct(m["x"]["start"].alias("start"), m["x"]["end"].alias("end"), m["x"]["value"].alias("value")))

        return bound(reached, kept)

    return bound(runs, lambda r: F.when((F.size(r) == 0) | (F.size(base) == 0), r).otherwise(bound(in_order(r), apart)))


def _pairs(value: Column, use) -> Column:
    """``use(index)`` for each pair of neighbouring characters; what ends a run (``=``) is a character too."""
    codes = F.transform(F.regexp_extract_all(value, F.lit("."), F.lit(0)), lambda c: F.ascii(c) - _FIRST)
    return bound(codes, lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c)), lambda a, b: use(a * _SIZE + b)))


@dataclass
class MarkovModels:
    """The logarithm of the ratio of both models' chances, by pair of characters; the margin that a run must reach; and, for
    reports, the shares of random and of ordinary samples that reach it."""

    ratio: np.ndarray
    margin: float
    found: float
    wrong: float

    def score(self, value: Column) -> Column:
        """The log-likelihood ratio of random against ordinary."""
        table = F.split(F.lit(" ".join(f"{x:.5f}" for x in self.ratio)), " ").cast("array<double>")
        return F.aggregate(_pairs(value, lambda i: F.get(table, i)), F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0)))

    def accepts(self, value: Column) -> Column:
        return self.score(value) >= self.margin


def _generated(spark) -> DataFrame:
    """(random, value): digests in two alphabets, and identifiers of two to five stems in four styles."""
    rows = spark.range(GENERATED).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    stems = F.array(*[F.lit(s) for s in STEMS])
    stem = lambda j: F.element_at(stems, F.pmod(F.xxhash64("id", F.lit(j)), F.lit(len(STEMS))).cast("int") + 1)
    words = F.slice(F.array(*[stem(j) for j in range(5)]), F.lit(1), (F.col("id") % 4 + 2).cast("int"))
    style = F.floor(F.col("id") / 4) % 4
    camel = F.array_join(F.transform(words, lambda w, i: F.when(i > 0, F.initcap(w)).otherwise(w)), "")
    named = F.when(style == 0, camel).when(style == 1, F.array_join(words, "_")).when(style == 2, F.array_join(words, "-")).otherwise(F.upper(F.array_join(words, "_")))
    coded = F.regexp_replace(F.base64(F.unhex("h")), "=", "")
    random = rows.select(F.lit(True).alias("random"), F.explode(F.array(F.col("h"), coded, F.upper(F.left("h", F.lit(20))))).alias("value"))
    return random.unionByName(rows.select(F.lit(False).alias("random"), named.alias("value")))


def samples(documents: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """(random, value) of the labelled samples: values of base spans, words of the sampled documents, and generated ones.

    Both samples are those with the smallest hashes, which needs no order of all rows: a bound for the hash follows
    from a count.
    """
    n = documents.count()
    least = lambda key, most, rows: F.shiftrightunsigned(F.xxhash64(*key), 33) < int(min(1.0, most / max(1, rows)) * 2**31)
    words = F.regexp_extract_all(F.left(text, F.lit(SAMPLE_CHARS)), F.lit(r"[A-Za-z][A-Za-z0-9+/_-]{3,}+"), F.lit(0))
    ordinary = documents.where(F.col(text).isNotNull() & least([text], SAMPLE_DOCS, n)).select(F.lit(False).alias("random"), F.explode(F.array_distinct(words)).alias("value"))
    ordinary = ordinary.where(~F.col("value").rlike(rf"{_ACCESS}|[0-9a-f]{{24}}") & ~F.col("value").rlike(r"^(?=[A-Za-z+/_-]*[0-9]).{16,}$"))
    values = found.select(F.explode("__base.value").alias("value"))
    total = values.count()
    random = values.where(least(["value"], SAMPLE_VALUES, total)).select(F.lit(True).alias("random"), "value")
    return ordinary.unionByName(random).distinct().unionByName(_generated(documents.sparkSession))


def fit(rows: DataFrame) -> MarkovModels:
    """Both models from labelled samples (random, value), by counted pairs of characters with one added to each that their
    alphabet has; of samples, only counts and two shares come to the driver."""
    pairs = rows.select("random", F.explode(_pairs(F.col("value"), lambda i: i)).alias("i"))
    counts = np.zeros((2, _SIZE, _SIZE))
    for random, i, n in pairs.where(F.col("i").between(0, _SIZE * _SIZE - 1)).groupBy("random", "i").count().collect():
        counts[int(random), i // _SIZE, i % _SIZE] = n
    used = np.zeros(_SIZE, bool)
    used[[ord(c) - _FIRST for c in "+-/_=.0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True
    counts += used
    chance = np.log(np.maximum(counts, 1e-9) / counts.sum(axis=2, keepdims=True).clip(1e-9))
    models = MarkovModels(np.where(used[:, None] & used, chance[1] - chance[0], 0.0).ravel(), 0.0, 0.0, 0.0)
    scored = rows.where((F.length("value") >= LEAST) & _various(F.col("value"))).select("random", models.score(F.col("value")).alias("score"))
    high = scored.where("NOT random").agg(F.percentile_approx("score", BELOW, 100_000)).first()[0]
    models.margin = max(ODDS, high or 0.0)
    told = dict(scored.groupBy("random").agg(F.avg((F.col("score") >= models.margin).cast("double"))).collect())
    models.found, models.wrong = told.get(True, 0.0), told.get(False, 0.0)
    return models


def find_secrets(documents: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``documents`` and ``__spans``: an array of (kind, start, end, value, score) by start, then kind; ``score``
    is null for base kinds."""
    places = durable(candidates(documents, text).drop(text))
    models = fit(durable(samples(documents, places, text)))
    return scanned(places, models)


def scanned(places: DataFrame, models: MarkovModels) -> DataFrame:
    scored = F.transform("__runs", lambda x: F.struct(x["start"].alias("start"), F.lit(len(BASE)).alias("k"), x["end"].alias("end"), x["value"].alias("value"), models.score(x["value"]).alias("score")))
    added = F.filter(scored, lambda x: x["score"] >= models.margin)
    base = F.transform("__base", lambda x: F.struct(x["start"], x["k"], x["end"], x["value"], F.lit(None).cast("double").alias("score")))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(F.array_sort(F.concat(base, added)), lambda x: F.struct(F.element_at(names, x["k"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), x["score"].alias("score")))
    return places.withColumn("__spans", spans).drop("__base", "__runs")


def op13_secrets(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: lambda x: x["kind"] == k
    count = {k: F.size(F.filter("__spans", of(k))).cast("long").alias(f"n_{k}") for k in KINDS}
    base = F.filter("__spans", lambda x: x["kind"] != KINDS[-1])
    return found.select("doc_id", *[count[k] for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"), count[KINDS[-1]])
