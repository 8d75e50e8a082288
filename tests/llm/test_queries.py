"""The queries against their SQL on whole tables."""

import os

import duckdb
import pytest

from objsync.llm.queries import ORACLE, QUERIES
from tests.test_oracle import normal

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield connection
    connection.close()


def test_ten_operators_have_a_query():
    assert [int(name.split("_")[0][2:]) for name in QUERIES] == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0 and normal(got) == normal(want)
