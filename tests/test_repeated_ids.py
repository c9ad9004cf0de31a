"""Ids outside the known range that come again: a repeat in the same file of a load, but not in another one."""

import duckdb
import pytest
from pyspark.sql import functions as F

from registrum.company_queries import known, shaped
from registrum.operators.normalize import COMPANY
from registrum.operators.routing import route_csv
from registrum.queries import ORACLES, QUERIES

#: Numbers of 5 to 8 digits whose first five are the same: 10008 to 10031, and groups of twelve that begin with those digits.
KEYS = [*range(9996, 10044), *range(100080, 100320), *range(1000800, 1001100), *range(10008000, 10008360)]


@pytest.mark.parametrize("name", ["r2_r3_route_csv", "d3_visible_duplicates"])
def test_numbers_of_more_than_five_digits(spark, tmp_path, name):
    table = tmp_path / "customer.parquet"
    spark.createDataFrame([(k,) for k in KEYS], "c_custkey long").write.parquet(str(table))
    c = duckdb.connect()
    c.execute(f"create view customer as select * from '{table}/*.parquet'")
    want = c.execute(ORACLES[name]).to_arrow_table()
    got = QUERIES[name](spark, str(tmp_path)).select(*want.column_names).toArrow()
    assert sorted((tuple(r.values()) for r in got.to_pylist()), key=repr) == sorted((tuple(r.values()) for r in want.to_pylist()), key=repr)


def test_foreign_ids_of_two_files(spark):
    lines = [
        ("a.csv", 2, "c_900001", "X", "1"),  # as the base
        ("a.csv", 3, "c_900001", "Y", "2"),  # repeats line 2
        ("a.csv", 4, "c_000002", "Z", "3"),  # applied
        ("b.csv", 2, "c_900001", "Z", "3"),  # the first of its file, as line 4 of a.csv
        ("b.csv", 3, "c_900001", "X", "1"),  # repeats line 2
        ("b.csv", 4, "c_000002", "Z", "3"),  # repeats line 4 of a.csv: a known id counts once in a load
        ("c.csv", 2, "c_900001", "W", "1"),  # the place of the base, under another name
        ("d.csv", 1, "c_900001", "V", "1"),  # the same again, under a third name
    ]
    df = spark.createDataFrame(lines, "source_file string, source_row int, id string, n string, a string")
    empty = F.array().cast("array<string>")
    values = dict(external_id=F.col("id"), name=F.col("n"), name_key=F.col("n"), city_key=F.lit("c"), address=F.col("a"))
    rows = shaped(df, **values).select("source_file", "source_row", F.lit("{}").alias("raw"), *COMPANY, F.lit(None).cast("string").alias("reason"), F.lit(False).alias("blank"), empty.alias("issues"), F.lit(False).alias("rejected"))
    base = known(spark.createDataFrame([("c_000001", "X", "1")], "id string, n string, a string"), **values)
    routed = route_csv(rows, base, "review_csv", F.current_timestamp())
    got = {(r.source_file, r.source_row): (r.status, r.issues) for r in routed.rows.collect()}
    foreign = "id_outside_known_range"
    assert got == {
        ("a.csv", 2): ("quarantined", [foreign, "duplicate_of_c_000001"]),
        ("a.csv", 3): ("duplicate", ["duplicate_of_line_2"]),
        ("a.csv", 4): ("applied", []),
        ("b.csv", 2): ("quarantined", [foreign, "duplicate_of_c_000002"]),
        ("b.csv", 3): ("duplicate", ["duplicate_of_line_2"]),
        ("b.csv", 4): ("duplicate", ["duplicate_of_line_4"]),
        ("c.csv", 2): ("quarantined", [foreign]),
        ("d.csv", 1): ("quarantined", [foreign]),
    }
    assert sorted(r.external_id for r in routed.companies.collect()) == ["c_000001", "c_000002"]
    candidates = {(r.external_id, r.duplicate_of, r.match_reason): r.details.new_name for r in routed.duplicates.collect()}
    assert routed.duplicates.count() == 3
    assert candidates == {("c_900001", "c_000001", "city_address+name"): "X", ("c_900001", "c_000002", "city_address+name"): "Z", ("c_900001", "c_000001", "city_address"): "V"}
