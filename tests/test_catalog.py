"""Every registered linkage query that has SQL gives DuckDB's rows at the smallest scale."""

import glob
import math
import os

import duckdb
import pytest

from linkmill.plans import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def _rows(df):
    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v

    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, FOLDER).toPandas()
    want = duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_end_to_end_gives_one_row_a_contact(spark):
    result = catalog.queries()["match_end_to_end"](spark, FOLDER).toPandas()
    assert result["source_row_number"].is_unique and len(result) == 200
    assert (result["match_status"] == "MATCH_CERTAIN").sum() > 10
