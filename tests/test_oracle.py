"""Every catalogued query against its SQL in DuckDB, as multisets of rows."""

import os

import duckdb
import pandas as pd
import pytest

from objsync.plans.oracle import ORACLE
from objsync.plans.queries import CATALOG, TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield connection
    connection.close()


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    cells = [["<null>" if pd.isna(v) else _text(v) for v in row] for row in frame.itertuples(index=False)]
    return sorted(map(tuple, cells))


def _text(value) -> str:
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if isinstance(value, float):
        return repr(int(value)) if value.is_integer() else repr(value)
    return str(value)


def test_every_query_has_an_oracle():
    assert set(CATALOG) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_sql(spark, duck, name):
    got = CATALOG[name](spark, SF).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) and len(want) > 0
    assert normal(got) == normal(want)
