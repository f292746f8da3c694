"""Line dedup and the Jaccard join against brute force."""

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lessonweave.llm import jaccard, line_dedup
from lessonweave.llm.components import connected_components

VOCABULARY = [a + b for a in "ka mo ti ren sul vor dap".split() for b in "ba no chi rat lim des".split()]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, id int, root double, n int"


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1, 0.5, 2) for i, t in rows], COLUMNS).repartition(3)


def corpus(seed):
    rng = random.Random(seed)
    line = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    shared, texts = [line(60) for _ in range(4)], []
    for _ in range(40):
        own = [line(rng.randint(1, 40)) for _ in range(3)]
        if rng.random() < 0.7:
            ws = rng.choice(shared).split()
            for _ in range(rng.randint(0, 2)):
                ws[rng.randrange(len(ws))] = rng.choice([*VOCABULARY, "of", "a"])
            own.insert(rng.randint(0, 3), " ".join(ws).upper() if rng.random() < 0.3 else " ".join(ws) + ".")
        texts.append("\n".join(own))
    return texts + [texts[3], texts[3], "", None, "...\n!!", "de la " * 5, "x\n\nx\n  x  ", line(200) + " " + "q" * 5000]


def edited(rng, line, share):
    """The line with up to ``share`` of its words replaced, left out or added, or with as many typing errors."""
    ws = line.split()
    if rng.random() < 0.25:
        at = rng.randrange(len(line))
        return line[:at] + rng.choice("xq") + line[at + rng.randint(0, 1) :]
    for _ in range(rng.randint(1, max(1, int(share * len(ws))))):
        at = rng.randrange(len(ws))
        ws[at : at + rng.randint(0, 1)] = [] if rng.random() < 0.2 and len(ws) > 2 else [rng.choice([*VOCABULARY, "of", "a"])]
    return " ".join(ws)


def line_links(norms):
    """All pairs of lines with an edit similarity of 0.8, by brute force."""
    table = pa.table({"i": range(len(norms)), "t": norms})  # noqa: F841
    most = "CAST(floor(0.2 * greatest(length(x.t), length(y.t)) + 1e-9) AS INT)"
    return duckdb.sql(f"SELECT x.i, y.i FROM \"table\" x JOIN \"table\" y ON x.i < y.i AND abs(length(x.t) - length(y.t)) <= {most} WHERE levenshtein(x.t, y.t) <= {most}").fetchall()


def ids_of(spark, norms):
    lines = spark.createDataFrame(list(enumerate(norms)), "i int, norm string")
    return {r["i"]: r["id"] for r in lines.select("i", F.xxhash64("norm").alias("id")).collect()}


@pytest.mark.parametrize("size, share", [(3, 0.2), (6, 0.2), (10, 0.2), (20, 0.2), (60, 0.15), (150, 0.1)])
def test_lines_by_length_are_linked(spark, size, share):
    """At least nine in ten pairs with an edit similarity of 0.8 are linked, and no others, at any length."""
    rng = random.Random(size)
    base = [" ".join(rng.choice(VOCABULARY) for _ in range(size)) for _ in range(12)]
    norms = sorted({*base, *(edited(rng, b, share) for b in base for _ in range(3))})
    links, ids = line_links(norms), ids_of(spark, norms)
    docs = frame(spark, list(enumerate(norms)))
    kept = {r["id"]: tuple(r["kept"]) for r in line_dedup.line_groups(docs).collect()}
    group = [kept.get(ids[i], i) for i in range(len(norms))]
    caught = sum(group[i] == group[j] for i, j in links)
    assert len(links) > 10 and caught >= 0.9 * len(links), (caught, len(links))
    want = roots(len(norms), links)
    assert all(want[i] == want[j] for i in range(len(norms)) for j in range(i) if group[i] == group[j])


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_keeps_one_of_each_group(spark, seed):
    """Against brute force over the edit similarity alone."""
    rows = list(enumerate(corpus(seed)))
    docs = frame(spark, rows)
    found = [r for r in line_dedup.numbered_lines(docs).collect() if r["norm"]]
    norms = sorted({r["norm"] for r in found})
    group = dict(zip(norms, roots(len(norms), line_links(norms)), strict=True))
    assert len(found) > 100 and len(set(group.values())) < len(norms)
    first = {}
    for r in found:
        first[group[r["norm"]]] = min(first.get(group[r["norm"]], (10**9,)), (r["doc"], r["key"], r["pos"]))
    drops = {}
    for r in found:
        if first[group[r["norm"]]] != (r["doc"], r["key"], r["pos"]):
            drops.setdefault(r["doc"], set()).add(r["pos"])
    out = line_dedup.dedup_lines(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        text = rows[r["doc_id"]][1]
        want = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drops.get(r["doc_id"], ()))
        assert r["text"] == want and r["__n_dropped"] == len(drops.get(r["doc_id"], ()))
        assert (r["key"], r["id"], r["root"], r["n"]) == ("k", 1, 0.5, 2)


def test_a_crowd_of_near_copies_is_linked(spark):
    """Where far more lines share a block than are compared in pairs."""
    rng = random.Random(11)
    base = " ".join(rng.choice(VOCABULARY) for _ in range(40))
    norms = sorted({edited(rng, edited(rng, base, 0.15), 0.15) for _ in range(300)})
    links, ids = line_links(norms), ids_of(spark, norms)
    kept = {r["id"]: tuple(r["kept"]) for r in line_dedup.line_groups(frame(spark, list(enumerate(norms)))).collect()}
    group = [kept.get(ids[i], i) for i in range(len(norms))]
    assert sum(group[i] == group[j] for i, j in links) >= 0.9 * len(links) > 1000


def letters_changed(rng, line, share, since):
    """One letter is another in a share of the words, from one of them on."""
    ws = line.split(" ")
    for i in rng.sample(range(since, len(ws)), int(share * len(ws))):
        at = rng.randrange(len(ws[i]))
        ws[i] = ws[i][:at] + rng.choice("abcdefghijklmnopqrstuvwxyz") + ws[i][at + 1 :]
    return " ".join(ws)


@pytest.mark.parametrize(("head", "salted"), [(False, False), (True, False), (True, True)])
def test_letters_in_a_quarter_of_the_words(spark, monkeypatch, head, salted):
    """Pairs of lines of which all may begin with the same three words, a block that a thousand lines share, dealt to many tasks or not."""
    if salted:
        monkeypatch.setattr(line_dedup, "SAMPLE_LINES", 1000)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9)))
    shared = [word() for _ in range(3)]
    lines = [" ".join((shared if head else [word() for _ in range(3)]) + [word() for _ in range(9)]) for _ in range(500)]
    norms = sorted({x for line in lines for x in (line, letters_changed(rng, line, 0.25, 3))})
    links, ids = line_links(norms), ids_of(spark, norms)
    kept = {r["id"]: tuple(r["kept"]) for r in line_dedup.line_groups(frame(spark, list(enumerate(norms)))).collect()}
    group = [kept.get(ids[i], i) for i in range(len(norms))]
    assert sum(group[i] == group[j] for i, j in links) >= 0.95 * len(links) > 400


def test_groups_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SAMPLE_LINES", 1000)
    docs = frame(spark, list(enumerate(corpus(5))))
    got = [sorted(map(str, line_dedup.line_groups(docs.repartition(n)).collect())) for n in (1, 5)]
    assert got[0] == got[1]


def test_frequent_blocks_lose_no_link(spark, monkeypatch):
    """With every block dealt to many tasks, and every join by a shuffle, the groups stay the same."""
    docs = frame(spark, list(enumerate(corpus(3))))
    want = sorted(tuple(r) for r in line_dedup.dedup_lines(docs).select("doc_id", "text", "__n_dropped").collect() if r["doc_id"] is not None)
    for name, value in (("SAMPLE_LINES", 1000), ("SALTS", 64), ("SMALL", 0)):
        monkeypatch.setattr(line_dedup, name, value)
    got = sorted(tuple(r) for r in line_dedup.dedup_lines(docs).select("doc_id", "text", "__n_dropped").collect() if r["doc_id"] is not None)
    assert got == want


def test_line_dedup_on_odd_tables(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
    rows = [(None, "one line of words"), (None, "one line of words"), (7, "one line of words"), (7, "one line of words\nmore")]
    got = sorted((str(r["doc_id"]), r["text"]) for r in line_dedup.dedup_lines(frame(spark, rows)).collect())
    assert got == [("7", ""), ("7", "more"), ("None", "one line of words"), ("None", "one line of words")]


def test_scripts_without_spaces(spark):
    rng = random.Random(2)
    line = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(200))
    rows = list(enumerate([line, line[:50] + "xx" + line[51:], "".join(reversed(line)), "z" * 40_000, "z " * 20_000]))
    assert [r["__n_dropped"] for r in sorted(line_dedup.dedup_lines(frame(spark, rows)).collect())] == [0, 1, 0, 0, 0]


def shingles(text):
    ws = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard_finds_every_link(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rng = random.Random(5)
    base = [[rng.choice(VOCABULARY) for _ in range(120)] for _ in range(3)]
    texts = []
    for _ in range(45):
        ws = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            ws[rng.randrange(len(ws))] = rng.choice(VOCABULARY)
        texts.append(" ".join(ws))
    texts += [texts[0], texts[0].upper(), "kaba mono", "Kaba, mono!", "", None, "...", " ".join(rng.choice(VOCABULARY) for _ in range(20_000))]
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    want = roots(len(sets), links)
    degree = [sum(i in p for p in links) for i in range(len(sets))]
    docs = frame(spark, list(enumerate(texts)))
    got = {r["doc"]: (r["first"]["doc"] if r["root"] is not None else r["doc"], r["links"] or 0) for r in jaccard.link_documents(docs).collect()}
    assert got == {i: (want[i], degree[i]) for i in range(len(sets))}
    left = jaccard.keep_first(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [i for i in range(len(sets)) if want[i] == i]


def test_jaccard_on_odd_tables(spark):
    assert jaccard.link_documents(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (3, "z y x w v u"), (4, "z y x w v u")]
    assert sorted((str(r["doc_id"]), r["text"]) for r in jaccard.keep_first(frame(spark, rows)).collect()) == [("3", "z y x w v u"), ("None", "a b c d e f")]
    assert jaccard.keep_first(frame(spark, rows[1:3])).count() == 1


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.95), (0.9, 0.99)):
        bands, rows = jaccard.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5)]
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    place = {x: i for i, x in enumerate(nodes)}
    want = roots(len(nodes), [(place[a], place[b]) for a, b in edges if a != b])
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long").withColumn("c", F.lit(1))).collect()}
    assert got == {x: nodes[want[place[x]]] for x in nodes}


def test_line_dedup_compares_all_lines_of_a_large_block(spark):
    """Pairs of lines of 30 words, all frequent, which have nothing but a head in common with 900 others: neighbours in an order of hashes miss many."""
    rng = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrt"]
    norms = []
    for _ in range(450):
        line = ["every", "line", "begins", "so", *[rng.choice(words) for _ in range(26)]]
        other = list(line)
        for at in (6, 10, 14, 18, 22, 26):  # one word of each run but the first
            other[at] = other[at][:2] + rng.choice("lmnrt")
        norms += [" ".join(line), " ".join(other)]
    kept = {r["id"]: tuple(r["kept"]) for r in line_dedup.line_groups(frame(spark, list(enumerate(norms)))).collect()}
    ids = [r["id"] for r in frame(spark, list(enumerate(norms))).select("doc_id", F.xxhash64("text").alias("id")).orderBy("doc_id").collect()]
    same = sum(a == b or (a in kept and kept.get(a) == kept.get(b)) for a, b in zip(ids[::2], ids[1::2], strict=True))
    assert same >= 445


@pytest.mark.parametrize("copies", [True, False])
def test_few_pairs_of_a_large_block_are_left(spark, monkeypatch, copies):
    """Near copies that fill a block which is dealt to many tasks, or a block's lines that have half of their words in common: pairs that cannot be linked, or lie in one group, are not written."""
    monkeypatch.setattr(line_dedup, "SAMPLE_LINES", 1000)
    rng, seen, across = random.Random(12), [], line_dedup._across
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9)))
    base = [word() for _ in range(40)]
    norms = sorted({edited(rng, " ".join(base), 0.1) if copies else " ".join([*base[:12], *[word() for _ in range(12)]]) for _ in range(300)})

    def counted(*args):
        found = across(*args)
        seen.append(found.count())
        return found

    monkeypatch.setattr(line_dedup, "_across", counted)
    links, ids = line_links(norms), ids_of(spark, norms)
    kept = {r["id"]: tuple(r["kept"]) for r in line_dedup.line_groups(frame(spark, list(enumerate(norms)))).collect()}
    group, want = [kept.get(ids[i], i) for i in range(len(norms))], roots(len(norms), links)
    assert all((group[i] == group[j]) == (want[i] == want[j]) for i in range(len(norms)) for j in range(i))
    assert sum(seen) < len(norms)


def test_line_dedup_splits_the_texts_once(spark, monkeypatch):
    """Every line is normalised and hashed in one pass; what goes is found by those hashes."""
    calls, numbered = [], line_dedup.numbered_lines
    monkeypatch.setattr(line_dedup, "numbered_lines", lambda documents: calls.append(1) or numbered(documents))
    docs = frame(spark, [(1, "ka ba mo chi\nown line here"), (2, "Ka ba, mo chi\n\nother words")])
    assert [(r["text"], r["__n_dropped"]) for r in sorted(line_dedup.dedup_lines(docs).collect())] == [("ka ba mo chi\nown line here", 0), ("\nother words", 1)]
    assert len(calls) == 1


def test_long_lines_of_one_language_are_not_compared_in_full(spark, monkeypatch):
    """Long lines with a common head and common words have near SimHashes. Those with too few pieces in common are left out
    before the edit distance; near copies of one of them are still found."""
    rng, seen, similar = random.Random(14), [], line_dedup._similar
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    head = [word() for _ in range(10)]
    norms = [" ".join([*head, *[w for _ in range(70) for w in ("the", word(), "of", "and")]]) for _ in range(40)]
    norms.append(norms[0].replace(norms[0].split()[15], "x"))

    def counted(pairs, *args):
        seen.append(pairs.count())
        return similar(pairs, *args)

    monkeypatch.setattr(line_dedup, "_similar", counted)
    kept = {r["id"]: tuple(r["kept"]) for r in line_dedup.line_groups(frame(spark, list(enumerate(norms)))).collect()}
    ids = ids_of(spark, norms)
    assert set(kept) == {ids[0], ids[len(norms) - 1]} and len(set(kept.values())) == 1
    assert sum(seen) < 3 * len(norms)
