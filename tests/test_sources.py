import socket
import threading

import pytest

from registrum.plans.search import display, escape_like, first_value, page_number, search
from registrum.sources.csv import csv_rows, parse, read_csv
from registrum.sources.named_sql import run_script, split_queries
from registrum.sources.network import lookup_domains, probe_mailboxes, smtp_answer
from registrum.sources.settings import load_env, require_env


def test_csv_shapes():
    assert parse('﻿id,name,city\r\nc_1,"ООО «А, Б»",Москва\r\nc_2,Б,Сочи\r\n') == (["id", "name", "city"], [(2, ["c_1", "ООО «А, Б»", "Москва"], None), (3, ["c_2", "Б", "Сочи"], None)])
    assert parse("id,name\r\nc_1,А\r\n,\r\n")[1][1] == (3, ["", ""], None)
    assert parse("id,name,city\nc_1,А\n")[1] == [(2, ["c_1", "А"], "column_count_2_expected_3")]
    assert parse('id,name\nc_1,"open')[1] == [(2, ["c_1", "open"], "unterminated_quote")]
    assert parse('id,name,city\nc_1,"x"y,z\n')[1] == [(2, ["c_1", "xy", "z"], "junk_after_closing_quote")]
    assert parse('id,a\nc_1,"say ""hi""\nthere"\nc_2,b\n')[1] == [(2, ["c_1", 'say "hi"\nthere'], None), (4, ["c_2", "b"], None)]
    assert parse("id,a\n\nc_1,b")[1] == [(2, [""], "column_count_1_expected_2"), (3, ["c_1", "b"], None)]
    assert parse('id,a\nx"y,b\n')[1] == [(2, ['x"y', "b"], None)]
    assert parse("") == ([], [])


def test_read_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('id,name\nc_1," x"\n ,\t\nc_2\n'.encode())
    rows = {r.source_row: r for r in csv_rows(read_csv(spark, str(tmp_path / "a.csv"))).collect()}
    assert rows[2].fields == {"id": "c_1", "name": " x"} and not rows[2].blank and rows[2].source_file == "a.csv"
    assert rows[3].blank and rows[4].reason == "column_count_1_expected_2" and rows[4].raw == '{"values":["c_2"]}'


def test_named_queries(spark, capsys):
    text = "SELECT 0;\n-- @name one\nSELECT 1 AS a;\n-- @name empty\n\n-- @name none \nSELECT 2 AS a WHERE false"
    assert split_queries(text) == {"one": "SELECT 1 AS a", "none": "SELECT 2 AS a WHERE false"}
    assert run_script(spark, text, show=True)["one"].first().a == 1
    assert "(no rows)" in capsys.readouterr().out


def test_settings():
    env = {"A": "kept"}
    load_env("# note\nA=1\nexport B = 'two words'\nC=\n", env)
    assert env == {"A": "kept", "B": "two words", "C": ""}
    assert require_env("B", env) == "two words"
    with pytest.raises(KeyError):
        require_env("C", env)


def test_domains_are_asked_once(spark):
    def resolver(d):
        if d == "slow.ru":
            import time

            time.sleep(3)
        if d == "bad.ru":
            raise OSError
        return True, f"mx.{d}", "exists"

    df = spark.createDataFrame([("a.ru",), ("a.ru",), ("bad.ru",), ("slow.ru",), (None,)], "domain string")
    got = {r.domain: tuple(r)[1:] for r in lookup_domains(df, resolver, seconds=0.5).collect()}
    assert got == {"a.ru": (True, "mx.a.ru", "exists"), "bad.ru": (False, None, "unknown"), "slow.ru": (False, None, "unknown")}


@pytest.mark.parametrize(("replies", "answer"), [(("220 hi", "250 ok", "250 ok", "250 ok"), "accepted"), (("220-a", "220 hi", "250 ok", "250 ok", "550 no"), "rejected"), (("220 hi", "250 ok", "250 ok", "451 later"), "unknown"), (("554 no",), "unknown"), (("220 hi", "500 no"), "unknown"), ((), "unknown")])
def test_smtp_sessions(replies, answer):
    server = socket.create_server(("127.0.0.1", 0))

    def serve():
        peer, _ = server.accept()
        with peer:
            for k, r in enumerate(replies):
                peer.sendall(f"{r}\r\n".encode())
                if r[3] != "-" and k < len(replies):
                    peer.settimeout(2)
                    try:
                        peer.recv(1000)
                    except OSError:
                        return

    threading.Thread(target=serve, daemon=True).start()
    assert smtp_answer("127.0.0.1", "a@b.ru", server.getsockname()[1], 2.0) == answer


def test_control_mailbox_is_asked_after_acceptance(spark):
    df = spark.createDataFrame([("a@x.ru", "x.ru", "h"), ("b@x.ru", "x.ru", "h"), ("c@y.ru", "y.ru", None)], "email string, domain string, mx_host string")
    got = {tuple(r) for r in probe_mailboxes(df, lambda host, email: "rejected" if email == "b@x.ru" else "accepted").collect()}
    assert got == {("a@x.ru", "accepted", "accepted"), ("b@x.ru", "rejected", "unknown")}


def test_search(spark):
    rows = [(f"c_{k}", name, city, rating, n, site) for k, (name, city, rating, n, site) in enumerate([("Альфа 100%", "Москва", 4.5, 3, "http://a.ru"), ("альфа", "Сочи", 4.5, None, None), ("Бета", "Москва", None, 9, None), ("Альфа_x", "Москва", 4.9, 1, None)])]
    df = spark.createDataFrame(rows, "external_id string, name string, city_key string, rating double, reviews_count int, site string")
    got = search(df, "АЛЬФА")
    assert [r.external_id for r in got.rows.collect()] == ["c_3", "c_1", "c_0"] and got.total == 3
    assert [r.external_id for r in search(df, "100%").rows.collect()] == ["c_0"]
    assert [r.external_id for r in search(df, "_").rows.collect()] == ["c_3"]
    last = search(df, city="Москва", page=99, size=2)
    assert (last.page, last.pages, [r.external_id for r in last.rows.collect()]) == (2, 2, ["c_2"])
    assert [tuple(r) for r in got.cities.collect()] == [("Москва", 3), ("Сочи", 1)]
    assert display(df.filter("external_id = 'c_0'")).first().site == "a.ru" and display(df.filter("external_id = 'c_1'")).first().site == "—"
    assert escape_like("a%_\\") == "a\\%\\_\\\\"
    assert first_value(["a", "b"]) == "a" and first_value(None) is None
    assert [page_number(x) for x in ("3", "2.9", "-1", "x", None, ["4"], "inf")] == [3, 2, 1, 1, 1, 4, 1]
