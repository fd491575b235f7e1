import duckdb
import pytest

from cytoframe.llm import queries as Q

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = Q.queries()[name](spark, SF).toPandas(), con.execute(Q.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) and all((a[c].astype(str) == b[c].astype(str)).all() for c in columns)


def test_each_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in Q.queries()] == list(range(1, 13))
