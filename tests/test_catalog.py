"""Every registered query of the image engine against its SQL in DuckDB."""

import duckdb
import numpy as np
import pytest

from cytoframe import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_agrees_with_sql(spark, db, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), db.execute(catalog.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert len(got) == len(want)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    for c in columns:
        if np.issubdtype(a[c].dtype, np.floating):
            np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), atol=2e-4, rtol=1e-5)
        else:
            assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql()) - {"cell_features"}))
def test_query_without_sql_gives_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_flagship_entry(spark):
    assert catalog.flagship(spark, SF).columns == ["drug", "n_cells", "mean_area", "last_number"]
