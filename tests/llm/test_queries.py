"""Registered queries at the oracle's scale, against DuckDB where SQL can express them."""

import pytest

duckdb = pytest.importorskip("duckdb")

from footfall.llm.queries import ORACLE, QUERIES  # noqa: E402
from tests.conftest import SF_ORACLE  # noqa: E402

TABLES = ("documents", "embeddings", "pages")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_duckdb(spark, connection, name):
    result = QUERIES[name](spark, SF_ORACLE)
    names = sorted(result.columns)
    got = sorted((tuple(r[c] for c in names) for r in result.collect()), key=str)
    relation = connection.execute(ORACLE[name])
    columns = [d[0] for d in relation.description]
    want = sorted((tuple(r[columns.index(c)] for c in names) for r in relation.fetchall()), key=str)
    assert sorted(columns) == names and got == want


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
