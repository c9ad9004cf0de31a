"""Facts about mail domains and mailboxes. They come in as tables; live probes run on executors and only when asked for."""

from __future__ import annotations

import socket
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DOMAIN_FACTS = "domain string, has_mx boolean, mx_host string, existence string"
SMTP_FACTS = "email string, real string, control string"
#: A mailbox that no domain has, for the control question.
CONTROL = "no-such-mailbox-7f3a9c"


def best_mx(records: DataFrame) -> DataFrame:
    """domain, mx_host: of records (domain, exchange, priority) the exchange of the least priority."""
    return records.groupBy("domain").agg(F.min_by("exchange", F.struct("priority", "exchange")).alias("mx_host"))


def resolve(domain: str) -> tuple[bool, str | None, str]:
    """(has_mx, mx_host, existence) by the system's resolver, which knows no MX records: a host stands for itself. A failure is not an absence."""
    try:
        socket.getaddrinfo(domain, 25)
        return True, domain, "exists"
    except socket.gaierror as e:
        gone = {getattr(socket, "EAI_NONAME", None), getattr(socket, "EAI_NODATA", None)}
        return False, None, "absent" if e.errno in gone else "unknown"
    except OSError:
        return False, None, "unknown"


def lookup_domains(domains: DataFrame, resolver: Callable[[str], tuple[bool, str | None, str]] = resolve, at_once: int = 24, seconds: float = 8.0) -> DataFrame:
    """DOMAIN_FACTS of the distinct domains, each asked for once, at_once at a time in each task; a domain that takes longer than seconds is unknown."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = ThreadPoolExecutor(at_once)
        for f in frames:
            names = f["domain"].tolist()
            rows = []
            for k in range(0, len(names), at_once):
                asked = [(d, pool.submit(resolver, d)) for d in names[k : k + at_once]]
                until = time.monotonic() + seconds
                for d, got in asked:
                    try:
                        rows.append((d, *got.result(max(0.0, until - time.monotonic()))))
                    except Exception:  # a resolver's failure of any kind says nothing about the domain
                        rows.append((d, False, None, "unknown"))
            yield pd.DataFrame(rows, columns=["domain", "has_mx", "mx_host", "existence"])
        pool.shutdown(wait=False, cancel_futures=True)

    return domains.select("domain").filter("domain is not null").distinct().mapInPandas(ask, DOMAIN_FACTS)


def smtp_answer(host: str, email: str, port: int = 25, seconds: float = 8.0, sender: str = "probe@localhost") -> str:
    """accepted, rejected or unknown, by one session up to RCPT; only a reply of 2xx or 5xx to RCPT decides."""
    until = time.monotonic() + seconds
    try:
        with socket.create_connection((host, port), seconds) as s:
            lines = s.makefile("rb")

            def reply() -> int:
                while True:
                    s.settimeout(max(0.01, until - time.monotonic()))
                    line = lines.readline()
                    if not line[3:4] == b"-":
                        return int(line[:3])

            if reply() != 220:
                return "unknown"
            for command in ("HELO localhost", f"MAIL FROM:<{sender}>"):
                s.sendall(f"{command}\r\n".encode())
                if reply() // 100 != 2:
                    return "unknown"
            s.sendall(f"RCPT TO:<{email}>\r\n".encode())
            code = reply()
            s.sendall(b"QUIT\r\n")
            return {2: "accepted", 5: "rejected"}.get(code // 100, "unknown")
    except (OSError, ValueError):
        return "unknown"


def probe_mailboxes(emails: DataFrame, answer: Callable[[str, str], str] = smtp_answer) -> DataFrame:
    """SMTP_FACTS of emails (email, domain, mx_host). The control mailbox is asked for only where the address is accepted."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for email, domain, host in zip(f["email"], f["domain"], f["mx_host"], strict=True):
                real = answer(host, email)
                rows.append((email, real, answer(host, f"{CONTROL}@{domain}") if real == "accepted" else "unknown"))
            yield pd.DataFrame(rows, columns=["email", "real", "control"])

    of = W.partitionBy("email").orderBy("mx_host")
    once = emails.filter("mx_host is not null").withColumn("k", F.row_number().over(of)).filter("k = 1")
    return once.select("email", "domain", "mx_host").mapInPandas(ask, SMTP_FACTS)
