"""Ordered scans equal windows over whole parts, and no range of a large part is much larger than the others."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lessonweave.operators import blocks, scans
from lessonweave.operators.answers import attach_to_number

N = 3_000


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows in one part, null parts, and the rest in many; as many tasks as make that third too much for one."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    rng = random.Random(5)
    data = []
    for i in range(N):
        part = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"p{rng.randrange(200)}"
        data.append((part, i, rng.choice([None, rng.randrange(50)]), rng.random() < 0.1))
    rng.shuffle(data)
    yield spark.createDataFrame(data, "part string, ord long, v int, mark boolean").repartition(4).cache()
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_equal_to_windows(rows):
    got = scans.prefix_scan(rows, ["part"], "ord", sums={"s": F.col("v")}, lasts={"l": F.col("v")}, highs={"h": F.col("v")}, firsts={"f": F.col("v")}, lags={"g": F.col("v")}, least=50)
    w = Window.partitionBy("part").orderBy("ord")
    run, every = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = rows.select("*", F.coalesce(F.sum(F.col("v").cast("long")).over(run), F.lit(0)).alias("s"), F.last("v", True).over(run).alias("l"), F.max("v").over(run).alias("h"), F.first("v", True).over(every).alias("f"), F.lag("v").over(w).alias("g"))
    got = got.select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_following_crosses_ranges(rows):
    got = scans.following(rows, ["part"], "ord", F.col("ord"), 4, "next", least=50)
    want = rows.withColumn("next", F.collect_list("ord").over(Window.partitionBy("part").orderBy("ord").rowsBetween(1, 4)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_part_is_split_evenly(rows):
    ranged, cut = scans.in_ranges(rows, ["part"], "ord", least=50)
    assert cut
    sizes = sorted(r["count"] for r in ranged.where("part = 'hot'").groupBy(scans.RANGE).count().collect())
    assert len(sizes) >= 2 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert ranged.where(f"coalesce(part, '') <> 'hot' AND {scans.RANGE} > 0").count() == 0


def test_small_parts_are_not(rows):
    assert not scans.in_ranges(rows.where("part <> 'hot'"), ["part"], "ord")[1]
    assert not scans.in_ranges(rows.limit(0), ["part"], "ord")[1]


def test_ties_stay_together(spark):
    rows = spark.createDataFrame([("a", 1, i) for i in range(300)] + [("a", 2, i) for i in range(300)], "part string, ord int, k int")
    got = {(r.ord, r.k): r.n for r in scans.places(rows, ["part"], ["ord", "k"], "n", least=50).collect()}
    assert got == {(o, k): (o - 1) * 300 + k + 1 for o in (1, 2) for k in range(300)}


def test_numbers_are_repaired_across_ranges(rows, monkeypatch):
    plain = {(r.part, r.ord): r.no for r in blocks.repair_numbers(rows, ["part"], ["ord"], "v").collect()}
    monkeypatch.setattr(blocks, "in_ranges", lambda r, p, o: scans.in_ranges(r, p, o, 50))
    assert {(r.part, r.ord): r.no for r in blocks.repair_numbers(rows, ["part"], ["ord"], "v").collect()} == plain
    by_part: dict = {}
    for part, ord_, v in sorted(((r.part or "", r.ord, r.v) for r in rows.collect())):
        by_part[part] = v if v is not None else by_part.get(part, 0) + 1
        assert plain[part or None, ord_] == by_part[part]


def test_pending_head(spark):
    rows = spark.createDataFrame([("d1", 0, None), ("d1", 1, 1), ("d1", 2, None), ("d1", 3, 2), ("d2", 0, None)], "doc string, o int, no int")
    assert [r.owner for r in attach_to_number(rows, "doc", "o", "no").orderBy("doc", "o").collect()] == [1, 1, 1, 2, None]
