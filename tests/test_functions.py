"""Single values through the cleaning functions."""

import pytest
from pyspark.sql import functions as F

from registrum.functions import email as em
from registrum.functions import fields as fn
from registrum.functions.fields import canonical_url
from registrum.functions.text import clean, name_key, recode, repair, strip

CITIES = ["Москва", "Санкт-Петербург", "Екатеринбург", "Сочи", "Пермь"]


def apply(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}").select("k", make(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.k)]


def test_clean_folds_markers_and_white_space(spark):
    got = apply(spark, ["  a \t b ", "N/A", " — ", "нет данных", "", None, " ﻿ x", "0"], clean)
    assert got == ["a b", None, None, None, None, None, "x", "0"]
    assert apply(spark, [" a b\n", ""], strip) == ["a b", ""]


def broken(text):
    return text.encode().decode("cp1251")


def test_repair(spark):
    bad = [broken("ООО «Заря Тех»"), broken("Москва")]
    fine = ["ООО «Ростов Трейд»", "АО «Восток Сервис»", "ИП Виноградов С. П.", "Санкт-Петербург", None]
    assert apply(spark, bad + fine, repair) == ["ООО «Заря Тех»", "Москва", *fine]
    assert recode("Р") == "Р" and recode("") == ""


def test_name_key(spark):
    forms = ["ООО", "ОАО", "ЗАО", "АО", "ПАО", "НАО", "ИП"]
    got = apply(spark, [f"{f} «Флагман Лаб»" for f in forms] + ["«Прайм Плюс»", "«Аонид»", "Ипотека Плюс", "АО. Сокол", None], name_key)
    assert got == ["флагман лаб"] * 7 + ["прайм плюс", "аонид", "ипотека плюс", "сокол", None]


def test_rating(spark):
    def r(values, number=False):
        return [(None if x["value"] is None else float(x["value"]), x["issues"]) for x in apply(spark, values, lambda v: fn.rating(v, F.lit(number)))]

    assert r(["4.1", "4.25", "5.1"], True) == [(4.1, []), (4.3, []), (None, ["rating_out_of_range"])]
    assert r(["4,5", "N/A", "7.2", "-3", "", None, "  ", "5d", "0x5", "1,2,3"]) == [
        (4.5, ["rating_decimal_comma"]),
        (None, ["rating_not_a_number"]),
        (None, ["rating_out_of_range"]),
        (None, ["rating_out_of_range"]),
        (None, []),
        (None, []),
        (None, ["rating_not_a_number"]),
        (None, ["rating_not_a_number"]),
        (5.0, []),
        (None, ["rating_decimal_comma", "rating_not_a_number"]),
    ]


def test_reviews(spark):
    def r(values, number=False):
        return [tuple(x) for x in apply(spark, values, lambda v: fn.reviews(v, F.lit(number)))]

    assert r(["191", "0", "-10.5"], True) == [(191, []), (0, []), (None, ["reviews_negative"])]
    got = r(["много", "-10", "45.5", "", None, "-0.4", " 7 ", "3,5", "  "])
    assert got == [(None, ["reviews_not_a_number"]), (None, ["reviews_negative"]), (46, ["reviews_not_integer"]), (None, ["reviews_missing"]), (None, ["reviews_missing"]), (None, ["reviews_negative"]), (7, []), (4, ["reviews_not_integer"]), (None, ["reviews_not_a_number"])]


def test_city(spark):
    values = ["Москва", "москва", "Moscow", "Москва ", "Санкат-Петербург", "ул. Советская, д. 89, офис 43", "Улан-Удэ", None, "", "Тверь, д. 5"]
    got = [tuple(x) for x in apply(spark, values, lambda v: fn.city(v, CITIES))]
    assert [(g[1], g[2]) for g in got] == [("Москва", []), ("Москва", ["city_case_mismatch"]), ("Москва", ["city_alias_or_translit"]), ("Москва", ["city_whitespace"]), ("Санкт-Петербург", ["city_typo_fixed"]), (None, ["city_looks_like_address"]), (None, ["city_unknown"]), (None, ["city_missing"]), (None, ["city_missing"]), (None, ["city_looks_like_address"])]
    assert got[5][0] is None and got[6][0] == "Улан-Удэ"


def test_the_first_of_equally_near_cities_wins(spark):
    assert apply(spark, ["абв"], lambda v: fn.nearest(v, ["абг", "абд"])) == ["абг"]
    assert apply(spark, ["абв"], lambda v: fn.nearest(v, [])) == [None]


def test_site(spark):
    values = ["https://sfera-group-229.ru", "нет сайта", "htp://sintez-service-453.ru", "", None, "Example.COM/Path/", "https:/x.ru", "localhost:80", "http://пример.рф/а b", "http://a.ru:80/?x=1", "нет.ru", "http://1.2"]
    got = [tuple(x) for x in apply(spark, values, fn.site)]
    assert got == [
        ("https://sfera-group-229.ru", []),
        (None, ["site_not_a_url"]),
        ("http://sintez-service-453.ru", ["site_scheme_typo"]),
        (None, []),
        (None, []),
        ("http://example.com/Path", ["site_scheme_missing"]),
        ("http://x.ru", ["site_scheme_typo"]),
        (None, ["site_scheme_missing", "site_not_a_url"]),
        ("http://xn--e1afmkfd.xn--p1ai/%D0%B0%20b", []),
        ("http://a.ru/?x=1", []),
        ("http://xn--m1abc.ru", ["site_scheme_missing"]) if canonical_url("http://нет.ru") == "http://xn--m1abc.ru/" else (canonical_url("http://нет.ru").rstrip("/"), ["site_scheme_missing"]),
        ("http://1.0.0.2", []),
    ]


@pytest.mark.parametrize(("text", "url"), [("http://a.b/../c/./d", "http://a.b/c/d"), ("HTTP://A.B:8080", "http://a.b:8080/"), ("http://a b.c", None), ("http://1.2.3.256", None), ("ftp://a.b", None), ("http://", None)])
def test_canonical_url(text, url):
    assert canonical_url(text) == url


def test_phone(spark):
    values = ["+7 (495) 248-44-40", "8 (925) 706-60-19", "8 (925) abc-12-34", "+7", "123456789012", "91234567890", "", None]
    assert [tuple(x) for x in apply(spark, values, fn.phone)] == [
        (values[0], "+74952484440", []),
        (values[1], "+79257066019", []),
        (values[2], None, ["phone_contains_letters"]),
        ("+7", None, ["phone_too_short"]),
        (values[4], None, ["phone_too_long"]),
        (values[5], None, ["phone_unexpected_format"]),
        (None, None, []),
        (None, None, []),
    ]


def test_domains_and_repairs(spark):
    sites = ["https://modul-plus-452.ru", "http://www.Nord-Trade-364.RU/kontakty", "https://ip-73.ru:8080/?utm=1", "нет сайта", "https://", "localhost", None]
    assert apply(spark, sites, em.mail_domain) == ["modul-plus-452.ru", "nord-trade-364.ru", "ip-73.ru", None, None, None, None]
    assert apply(spark, ["a.ru", None], em.candidates) == [["info@a.ru", "sales@a.ru", "contact@a.ru"], None]
    got = [tuple(x) for x in apply(spark, ["ivan@gmial.com", "ivan@mial.ru", "ivan@example..com", "info@modul-plus-452.ru", "x"], em.fix_domain)]
    assert got == [("ivan@gmail.com", True), ("ivan@mail.ru", True), ("ivan@example.com", True), ("info@modul-plus-452.ru", False), ("x", False)]


def test_syntax(spark):
    bad = {"x.ru": "no_at", "two@@example.com": "multiple_at", "a b@example.com": "whitespace", "@example.com": "empty_local", "a@example": "domain_without_dot", ".a@example.com": "bad_dots_in_local", "a@-example.com": "bad_hyphen_in_domain", "a@example.123": "bad_tld", "a@": "empty_domain", "a" * 65 + "@b.ru": "local_too_long", "a@" + "b" * 260 + ".ru": "too_long", "a@б.ru": "bad_domain_chars"}
    got = apply(spark, ["info@zenit-lab-152.ru", "a.b-c+d@sub.example.com", *bad], em.syntax)
    assert got[:2] == [[], []]
    for name, issues in zip(bad.values(), got[2:], strict=True):
        assert f"syntax_{name}" in issues


def test_verdicts(spark):
    emails = ["info@zenit-lab-152.ru", "nikita@example.com", "user@mailinator.com", "совсем не адрес", " Sales+spb@Gmial.com"]
    got = apply(spark, emails, em.offline_verdict)
    assert [(v.status, v.stage_failed, v.issues) for v in got] == [
        ("unknown", None, ["role_account"]),
        ("unknown", None, []),
        ("rejected", "disposable", ["disposable_domain"]),
        ("rejected", "syntax", ["syntax_no_at"]),
        ("unknown", None, ["domain_typo_fixed", "role_account"]),
    ]

    def final(email, mx, existence, smtp):
        df = spark.createDataFrame([(email, mx, existence, smtp)], "e string, mx boolean, x string, s string")
        v = df.select(em.offline_verdict(F.col("e")).alias("v"), "*").select(em.final_verdict(F.col("v"), F.col("mx"), F.col("x"), F.col("s")).alias("f")).first().f
        return v.status, v.stage_failed, v.issues

    assert final("info@a.ru", False, "exists", None) == ("rejected", "mx", ["role_account", "domain_has_no_mx"])
    assert final("info@a.ru", True, "exists", "accepted") == ("quarantined", None, ["role_account"])
    assert final("nikita@a.ru", True, "exists", "accepted") == ("valid", None, [])
    assert final("nikita@a.ru", True, "exists", "catch_all") == ("quarantined", "smtp", ["smtp_catch_all"])
    assert final("nikita@a.ru", True, "exists", "rejected") == ("rejected", "smtp", ["smtp_mailbox_rejected"])
    assert final("nikita@a.ru", True, "exists", None) == ("unknown", None, ["smtp_not_checked"])
    assert final("nikita@a.ru", None, None, None) == ("unknown", None, ["dns_lookup_failed"])
    assert final("nikita@a.ru", False, "absent", None) == ("rejected", "mx", ["domain_has_no_mx", "domain_does_not_exist"])
    assert final("x", False, "absent", None) == ("rejected", "syntax", ["syntax_no_at", "domain_does_not_exist"])


def test_smtp_answers(spark):
    pairs = [("accepted", "accepted"), ("accepted", "rejected"), ("accepted", "unknown"), ("rejected", "accepted"), ("unknown", "accepted")]
    df = spark.createDataFrame(pairs, "a string, b string").select(em.interpret_smtp(F.col("a"), F.col("b")).alias("r"))
    assert [r.r for r in df.collect()] == ["catch_all", "accepted", "accepted", "rejected", "unknown"]
