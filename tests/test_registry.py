"""Every registered query against its SQL in DuckDB on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from passgrid.catalog import batch, streams

DATA = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()
QUERIES = {name: query for name, query in registry.queries().items() if name in {**batch.QUERIES, **streams.QUERIES}}

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def values(frame):
    frame = frame[sorted(frame.columns)]
    for c in frame.columns:
        if str(frame[c].dtype).startswith("datetime"):
            frame = frame.assign(**{c: frame[c].astype("datetime64[us]").astype(str)})
    return sorted(
        tuple("NULL" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v) for v in row)
        for row in frame.itertuples(index=False)
    )


def test_every_query_has_sql():
    assert set(QUERIES) == {**batch.QUERIES, **streams.QUERIES}.keys() <= set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert values(got.toPandas()) == values(want)


def test_entry(spark):
    assert registry.entry(spark).count() == 989
