"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import duckdb
import pytest

from lessonweave import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(frame):
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or str(v) in ("nan", "<NA>", "None", "NaT"):
            return None
        return int(v) if isinstance(v, float) and v == int(v) else v

    return sorted(repr(tuple(map(plain, r))) for r in frame.astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs_without_sql(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
