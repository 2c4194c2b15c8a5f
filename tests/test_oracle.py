"""Every registered query against its SQL counterpart in DuckDB."""

from collections import Counter

import pytest

duckdb = pytest.importorskip("duckdb")

from queuelake.plans.oracle import ORACLE  # noqa: E402
from queuelake.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events", "documents", "pages")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = Counter(tuple(r) for r in frame.select(*columns).collect())
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(oracle.execute(f"SELECT {listed} FROM ({ORACLE[name]})").fetchall())
    assert got == expected
