"""Queries against their SQL on rows that the tables do not hold."""

import duckdb

from lessonweave import registry


def rows_and_wanted(spark, folder, name, **tables):
    """Sorted rows of the query and of its SQL over ``tables``, each a (rows, schema)."""
    c = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        c.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet/*.parquet')")
    want = c.sql(registry.ORACLE_SQL[name])
    got = registry.QUERIES[name](spark, str(folder)).select(*want.columns).collect()
    return sorted(map(tuple, got)), sorted(want.fetchall())


def test_rectangle_covered_by_its_share_exactly(spark, tmp_path):
    """0.6 * 36 * 15 is 324 or a little less, by the order of the products; the picture covers 27 * 12."""
    items = [(1, 31, 11, 1, 1.0), (1, 22, 8, 1, 1.0), (2, 31, 11, 1, 1.0), (2, 21, 8, 1, 1.0)]
    got, want = rows_and_wanted(spark, tmp_path, "rect_overlap_anti", lineitem=(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"))
    assert got == want and len(want) == 1


def test_long_urls_are_coded_in_one_line(spark, tmp_path):
    pages = [(1, "https://a.example/" + "x" * 200 + "?q=1"), (2, "http://b.example/"), (3, None)]
    got, want = rows_and_wanted(spark, tmp_path, "url_parts", pages=(pages, "page_id long, url string"))
    assert repr(got) == repr(want)


def test_chapters_are_counted_and_listed_whole(spark, tmp_path):
    """A chapter without lessons, lessons without resources, more names than a piece holds, and a name that is null."""
    customers = [(k, f"c{k}", k % 3) for k in range(3_500)] + [(9_000, None, 1), (9_001, None, 4)]
    got, want = rows_and_wanted(
        spark, tmp_path, "catalog_rollup", region=([(0, "A"), (1, "B"), (2, "C")], "r_regionkey int, r_name string"), customer=(customers, "c_custkey long, c_name string, c_nationkey int"),
        nation=([(0, "x", 0), (1, "y", 0), (2, "z", 1), (3, "empty", 1), (4, "unnamed", 1)], "n_nationkey int, n_name string, n_regionkey int"),
    )
    assert got == want and [r[:3] for r in got] == [("A", 2, 2335), ("B", 3, 1167), ("C", 0, None)]
