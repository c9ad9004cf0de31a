"""Loads of invented pages and CSV deltas, run twice; searches for duplicates; e-mail candidates; streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from registrum.operators import checks
from registrum.operators.emails import derive, judge
from registrum.plans import analytics
from registrum.sources.network import DOMAIN_FACTS
from registrum.sources.pages import page_items, read_pages
from registrum.sources.registry import Conflict, Registry
from registrum.streaming.ingest import start


def item(k, **more):
    base = {"id": f"c_{k:06d}", "name": f"ООО «Фирма {k}»", "category": "Пекарня" if k % 2 else "Логистика", "city": "Москва" if k % 3 else "Сочи", "address": f"ул. Мира, д. {k}", "rating": 4.0 + k % 10 / 10, "reviews_count": 10 + k, "site": f"https://firma-{k}.ru", "phone": f"+7495000{k:04d}"}
    return base | more


def write_pages(folder, *pages):
    folder.mkdir(exist_ok=True)
    for n, items in enumerate(pages, 1):
        (folder / f"page_{n:03d}.json").write_text(json.dumps({"page": n, "per_page": len(items), "total": sum(map(len, pages)), "items": items}, ensure_ascii=False))
    (folder / "page_x.json").write_text("{}")
    return str(folder)


PAGES = [[item(1), item(2, rating=None), item(3, rating="4,5", extra=" x ")], [item(4, reviews_count=0), item(1, name="other"), item(5, id=None)]]
HEADER = "id,name,category,city,address,rating,reviews_count,site,phone\n"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("registry")
    r = Registry(spark, f"file://{at}/tables")
    r.create()
    folder = write_pages(at / "pages", *PAGES)
    first = r.load_pages(folder)
    again = r.load_pages(folder)
    lines = [
        "c_000001,ООО «Фирма 1»,Пекарня,Москва,\"ул. Мира, д. 1\",4.1,11,https://firma-1.ru,+74950000001",  # 2 unchanged
        "c_001002,Новая,Кофейня,москва,\"ул. Новая, д. 2\",\"4,5\",45.5,нет сайта,8 (495) 777-00-02",  # 3 applied
        "c_900001,АО Чужая,Кофейня,Сочи,\"ул. Чужая, д. 3\",4,5,,",  # 4 foreign
        "c_001003,Фирма 2,Логистика,Москва,\"ул. Мира, д. 2\",4,5,,",  # 5 strong: place and name of c_000002
        "c_001004,Сдвиг,Пермь,\"ул. Мира, д. 9\",,4,5,,",  # 6 structural
        "c_001002,Новая,Кофейня,Москва,\"ул. Новая, д. 2\",4,5,,",  # 7 repeats line 3
        "c_001005,Вторая,Кофейня,Москва,\"ул. Новая, д. 2\",4,5,,84957770002",  # 8 strong: line 3, phone and place
        "c_001006,Третья,Кофейня,Москва,\"ул. Новая, д. 2\",4,5,,",  # 9 medium: line 3; line 8 was not admitted
        ",,,,,,,,",  # 10 blank
        "c_001007,x",  # 11 short
        "c_000004,ООО «Фирма 4»,,,,,3,,",  # 12 updates c_000004
        "c_001008,Пятая,Кофейня,Сочи,\"ул. Иная, д. 1\",4,5,,+74950000004",  # 13 low: phone of c_000004
    ]
    (at / "review.csv").write_text(HEADER + "\n".join(lines) + "\n")
    delta = r.load_csv(f"file://{at}/review.csv")
    return r, first, again, delta, at


def test_pages_load_and_rerun(loaded):
    _, first, again, _, _ = loaded
    assert {k: first[k] for k in ("files", "rowsRead", "inserted", "updated", "unchanged", "rejected")} == {"files": 2, "rowsRead": 6, "inserted": 4, "updated": 0, "unchanged": 1, "rejected": 1}
    assert first["issues"] == {"extra_whitespace": 1, "id_missing": 1, "rating_decimal_comma": 1, "rating_missing_with_reviews": 1, "rating_without_reviews": 1}
    assert (again["inserted"], again["updated"], again["unchanged"]) == (0, 0, 5)


def test_csv_routing(loaded):
    r, _, _, delta, _ = loaded
    rows = {x.source_row: x for x in r.table("import_rows").filter("source_file = 'review.csv'").collect()}
    assert {k: x.status for k, x in rows.items()} == {2: "unchanged", 3: "applied", 4: "quarantined", 5: "quarantined", 6: "quarantined", 7: "duplicate", 8: "quarantined", 9: "applied", 10: "rejected", 11: "rejected", 12: "applied", 13: "applied"}
    assert rows[3].issues == ["city_case_mismatch", "rating_decimal_comma", "reviews_not_integer", "site_not_a_url"]
    assert rows[4].issues[-1] == "id_outside_known_range" and rows[5].issues[-1] == "duplicate_of_c_000002"
    assert rows[6].issues[-1] == "broken_row_structure" and rows[7].issues[-1] == "duplicate_of_line_3" and rows[8].issues[-1] == "duplicate_of_c_001002"
    assert rows[10].issues == ["blank_row"] and rows[11].issues == ["column_count_2_expected_9"] and rows[10].external_id is None
    assert {k: delta[k] for k in ("rowsRead", "inserted", "updated", "unchanged", "quarantined", "rejected")} == {"rowsRead": 12, "inserted": 3, "updated": 1, "unchanged": 2, "quarantined": 4, "rejected": 2}
    assert "column_count_2_expected_9" not in delta["issues"] and "duplicate_of_line_3" not in delta["issues"] and delta["issues"]["blank_row"] == 1


def test_duplicate_candidates(loaded):
    r, *_ = loaded
    got = {(x.external_id, x.duplicate_of, x.match_reason, x.confidence) for x in r.table("duplicate_candidates").collect()}
    assert got == {("c_001003", "c_000002", "city_address+name", "high"), ("c_001005", "c_001002", "phone+city_address", "high"), ("c_001006", "c_001002", "city_address", "medium"), ("c_001008", "c_000004", "phone", "low")}


def test_nulls_do_not_replace_values_but_zeros_do(loaded):
    r, *_ = loaded
    c = r.table("companies").filter("external_id = 'c_000004'").first()
    assert (c.category, c.city_key, c.reviews_count, float(c.rating), c.source, c.source_file, c.source_row) == ("Логистика", "Москва", 3, 4.4, "api_pages", "review.csv", 12)


def test_report(loaded):
    r, *_ = loaded
    got = {k: df.collect() for k, df in analytics.report(r.table).items()}
    assert len(got["runs"]) == 3 and {x.source: x.runs for x in got["runs_by_source"]} == {"api_pages": 2, "review_csv": 1}
    assert {x.metric: x.value for x in got["reconciliation"]}["companies"] == "7" and len(got["reconciliation"]) == 19
    assert [x.csv_line for x in got["quarantine"]] == [4, 5, 6, 8]
    assert got["codes_and_cities"][0].landline == 6 and got["chance_matches"][0].landlines == 6
    for name, plan in analytics.QUERIES.items():
        assert plan(r.table("companies")).count() >= 1, name


def test_emails(loaded, spark):
    r, *_ = loaded
    facts = spark.createDataFrame([("firma-1.ru", True, "mx", "exists"), ("firma-2.ru", False, None, "absent")], DOMAIN_FACTS)
    derived = derive(r.table("companies"))
    r.replace_emails(judge(derived, facts))
    got = r.table("email_candidates")
    assert got.count() == 12 and got.filter("stage_failed = 'mx'").count() == 3
    assert got.filter("email = 'info@firma-1.ru'").first().issues == ["role_account", "smtp_not_checked"]
    r.replace_emails(judge(derived, facts))
    assert r.table("email_candidates").count() == 12


def test_reset_keeps_emails(spark, tmp_path):
    r = Registry(spark, f"file://{tmp_path}/t")
    r.create()
    r.load_pages(write_pages(tmp_path / "p", PAGES[0]))
    r.replace_emails(judge(derive(r.table("companies")), spark.createDataFrame([], DOMAIN_FACTS)))
    r.reset()
    assert r.table("companies").count() == 0 and r.table("email_candidates").count() == 9
    with pytest.raises(ValueError, match="no companies"):
        (tmp_path / "a.csv").write_text(HEADER)
        r.load_csv(str(tmp_path / "a.csv"))


def test_a_failed_load_changes_nothing(spark, tmp_path, monkeypatch):
    r = Registry(spark, f"file://{tmp_path}/t")
    r.create()
    monkeypatch.setattr(r, "_point", lambda to, onto: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        r.load_pages(write_pages(tmp_path / "p", PAGES[0]))
    assert r.table("companies").count() == 0 and r.table("import_runs").count() == 0
    assert not list(tmp_path.glob("t/steps-*"))


def test_the_second_of_two_loads_is_refused(spark, tmp_path):
    r = Registry(spark, f"file://{tmp_path}/t")
    r.create()
    empty = {"companies": r.table("companies")}
    r.commit(empty, 1)
    with pytest.raises(Conflict):
        r.commit(empty, 1)
    assert r.version() == 2


def test_stream(spark, tmp_path):
    r = Registry(spark, f"file://{tmp_path}/t")
    r.create()
    folder = write_pages(tmp_path / "p", *PAGES)
    start(r, folder, str(tmp_path / "c"), ["Москва", "Сочи"]).awaitTermination(120)
    assert r.table("companies").count() == 4


def test_envelope_checks(spark, tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    bodies = [{"page": 1, "per_page": 1, "total": 2, "items": [{}]}, {"page": 3, "per_page": 2, "total": 3, "items": [{}]}, {"page": "x", "per_page": 0, "total": 2, "items": []}, {"items": 5}]
    for n, body in enumerate(bodies, 1):
        (folder / f"page_{n}.json").write_text(json.dumps(body))
    pages = read_pages(spark, str(folder))
    got = {(r.source_file, r.problem) for r in checks.envelope_problems(pages).collect()}
    assert got == {("page_4.json", "no items array"), ("page_3.json", "page = x"), ("page_2.json", "items = 1, per_page = 2"), (None, "totals differ: 2, 3"), (None, "page numbers are not 1 to 3")}
    assert page_items(pages).count() == 2
    with pytest.raises(Exception):  # noqa: B017
        read_pages(spark, str(tmp_path / "none"))


def test_small_patterns(spark):
    df = spark.createDataFrame([(k,) for k in (1, 2, 5, 5, 1000002)], "n int")
    assert checks.gaps(df.filter("n < 10"), "n").count() == 2
    assert checks.gaps(df, "n").agg(F.count("*"), F.max("missing")).first() == (999998, 1000001)
    assert [tuple(r) for r in checks.repeated(df, "n").collect()] == [(5, 2)]


@pytest.mark.skipif("REGISTRY_PAGES" not in os.environ, reason="REGISTRY_PAGES names no folder of pages")
def test_known_export(spark, tmp_path):
    r = Registry(spark, f"file://{tmp_path}/t")
    r.create()
    got = r.load_pages(os.environ["REGISTRY_PAGES"])
    assert (got["rowsRead"], got["inserted"], got["unchanged"], got["issues"]) == (1000, 994, 6, {"rating_missing_with_reviews": 65, "rating_without_reviews": 5})
