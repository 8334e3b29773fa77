"""Every query with SQL gives the rows that DuckDB gives on the same tables; the others run."""

import os

import duckdb
import pandas as pd
import pytest

from tributary import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        return f"{float(v):.9g}" if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    if name in queries.ORACLE_SQL:
        want = duck.execute(queries.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got) > 0
