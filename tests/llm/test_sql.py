"""The training-data queries that SQL can express give the rows that DuckDB gives."""

import duckdb
import pytest

from lessonweave.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels", "pages"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(want) > 0
    rows = lambda frame: sorted(tuple(r) for r in frame[columns].astype(object).itertuples(index=False))
    assert rows(got) == rows(want)
