import duckdb
import pytest

from registrum.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, data, name):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{data}/sf0.001/documents.parquet'")
    got, want = QUERIES[name](spark, str(data / "sf0.001")).toArrow(), c.execute(ORACLES[name]).to_arrow_table()
    names = sorted(got.column_names)
    assert names == sorted(want.column_names)
    assert sorted(tuple(r[n] for n in names) for r in got.to_pylist()) == sorted(tuple(r[n] for n in names) for r in want.to_pylist())


def test_ten_queries():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 11))
