"""Each query of the registry against its SQL in DuckDB."""

import duckdb
import pytest

from registrum.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{data}/sf0.001/{t}.parquet'")
    return c


def rows(table):
    names = sorted(table.column_names)
    return sorted((tuple(r[n] for n in names) for r in table.to_pylist()), key=repr)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, data, name):
    got = QUERIES[name](spark, str(data / "sf0.001")).toArrow()
    want = duck.execute(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows(got) == rows(want)
