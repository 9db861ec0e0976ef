import duckdb
import pytest

from plenum import queries
from plenum.plans import views

QUERIES, ORACLE_SQL = queries.QUERIES | views.QUERIES, queries.ORACLE_SQL | views.ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation", "events", "region"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got, want = QUERIES[name](spark, sf), con.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = want.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, rows))
