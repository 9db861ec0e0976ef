import duckdb
import pytest

from plenum.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, name, size):
    d, con = f"/root/testdata/{size}", duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, d), con.sql(queries.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = want.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, rows))
