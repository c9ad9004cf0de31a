"""The fields of a company: city, rating, reviews, site, phone. Each function gives a struct with the value and an array of issues."""

from __future__ import annotations

import re
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .constants import ADDRESS, CITY_ALIASES, SCHEME_TYPO
from .steps import Steps, inline
from .text import BLANK, clean, is_empty_marker, squeeze, strip


def issues(*tests: tuple[Column, str]) -> Column:
    """The names whose tests hold, in order."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in tests]))


def result(value: Column, found: Column, kind: str, name: str = "value") -> Column:
    return F.struct(value.cast(kind).alias(name), found.alias("issues"))


@inline
def number(c: Column) -> Steps:
    """The number that a text spells: decimals with an exponent, or 0x, 0o and 0b forms; null for other texts."""
    parts = [(r"^0[xX][0-9a-fA-F]+$", 16), (r"^0[oO][0-7]+$", 8), (r"^0[bB][01]+$", 2)]
    out = F.when(c.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), c.try_cast("double"))
    for pattern, base in parts:
        out = out.when(c.rlike(pattern), F.conv(F.substring(c, 3, 64), base, 10).try_cast("double"))
    at = yield {"number": out}
    return F.when(F.abs(at["number"]) < float("inf"), at["number"])


@inline
def rating(raw: Column, is_number: Column) -> Steps:
    """A rating from 0 to 5 with one decimal, halves up. raw: text; is_number: the source gave a number."""
    at = yield {"text": strip(raw), "given": raw.isNotNull() & (is_number | (raw != ""))}
    text, given = at["text"], at["given"]
    at = yield {"marker": ~is_number & is_empty_marker(text), "dotted": F.regexp_replace(text, r"^([^,]*),", "$1.")}
    marker = at["marker"]
    spelled = yield from number.steps(at["dotted"])
    at = yield {"spelled": spelled}
    at = yield {"value": F.when(is_number, raw.try_cast("double")).when(~marker, at["spelled"])}
    value = at["value"]
    at = yield {"outside": (value < 0) | (value > 5)}
    comma = ~is_number & ~marker & text.contains(",")
    found = issues((given & comma, "rating_decimal_comma"), (given & value.isNull(), "rating_not_a_number"), (given & at["outside"], "rating_out_of_range"))
    return result(F.when(given & ~at["outside"], F.floor(value * 10 + 0.5) / 10), found, "decimal(2,1)")


@inline
def reviews(raw: Column, is_number: Column) -> Steps:
    """A count of reviews. A negative one is refused before fractions are rounded, halves up."""
    at = yield {"text": strip(raw), "missing": raw.isNull() | (~is_number & (raw == ""))}
    text, missing = at["text"], at["missing"]
    spelled = F.when(text.rlike(r"^-?[0-9]+([.,][0-9]+)?$"), F.regexp_replace(text, ",", ".").try_cast("double"))
    at = yield {"value": F.when(~missing, F.when(is_number, raw.try_cast("double")).otherwise(spelled))}
    value = at["value"]
    whole = value == F.floor(value)
    found = issues((missing, "reviews_missing"), (~missing & value.isNull(), "reviews_not_a_number"), (value < 0, "reviews_negative"), ((value >= 0) & ~whole, "reviews_not_integer"))
    return result(F.when(value >= 0, F.floor(value + 0.5)).try_cast("int"), found, "int")


@inline
def phone(raw: Column) -> Steps:
    """phone as given, e164 as +7 and ten digits, issues."""
    text = yield from clean.steps(raw)
    at = yield {"phone": text}
    text = at["phone"]
    at = yield {"letters": text.rlike("(?iu)[a-zа-яё]"), "digits": F.regexp_replace(text, "[^0-9]", "")}
    letters = at["letters"]
    at = yield {"size": F.length(at["digits"]), "national": F.regexp_replace(at["digits"], "^[78]", "")}
    size, national = at["size"], at["national"]
    found = issues((letters, "phone_contains_letters"), (~letters & (size < 11), "phone_too_short"), (~letters & (size > 11), "phone_too_long"), (~letters & (size == 11) & (F.length(national) != 10), "phone_unexpected_format"))
    e164 = F.when(~letters & (size == 11) & (F.length(national) == 10), F.concat(F.lit("+7"), national))
    return F.struct(text.alias("phone"), e164.alias("e164"), found.alias("issues"))


# Sites

#: Addresses that need no more than lower case for the host.
SIMPLE_URL = r"^[hH][tT][tT][pP][sS]?://([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]([A-Za-z0-9-]*[A-Za-z0-9])?(/[A-Za-z0-9_~%=&+,;:@!$()*-][A-Za-z0-9_~%=&+,;:@!$()*.-]*)*/?$"
DEFAULT_PORTS = {"http": 80, "https": 443}


def _ipv4(host: str) -> str | None:
    """The dotted form of a host whose last label is a number; None if it is none. Raises ValueError for numbers out of range."""
    labels = host.removesuffix(".").split(".")

    def value(x: str) -> int | None:
        if re.fullmatch(r"0[xX][0-9a-fA-F]*", x):
            return int(x[2:] or "0", 16)
        if re.fullmatch(r"0[0-7]*", x):
            return int(x, 8)
        return int(x) if re.fullmatch(r"[0-9]+", x) else None

    if not re.fullmatch(r"[0-9]+|0[xX][0-9a-fA-F]*", labels[-1]):
        return None
    numbers = [value(x) for x in labels]
    if len(numbers) > 4 or None in numbers or any(n > 255 for n in numbers[:-1]) or numbers[-1] >= 256 ** (5 - len(numbers)):
        raise ValueError(host)
    total = numbers[-1] + sum(n << 8 * (3 - k) for k, n in enumerate(numbers[:-1]))
    return ".".join(str(total >> s & 255) for s in (24, 16, 8, 0))


def canonical_url(text: str) -> str | None:
    """An http(s) address as a browser writes it, or None if it is no address: host in lower case ASCII, default port dropped, dot segments
    resolved, other characters percent-encoded."""
    m = re.match(r"^(https?):[\\/]*([^\\/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$", re.sub(r"[\t\n\r]", "", text.strip("".join(map(chr, range(33))))), re.I | re.S)
    if not m:
        return None
    scheme, authority, path, query, mark = m[1].lower(), m[2], m[3].replace("\\", "/"), m[4] or "", m[5] or ""
    user, _, server = authority.rpartition("@")
    name, colon, port = server.partition(":") if not server.startswith("[") else (server, "", "")
    if not name or (port and not port.isdigit()) or (port and int(port) > 65535):
        return None
    try:
        host = name.lower() if name.isascii() else name.lower().encode("idna").decode()
        if re.search(r"[\x00-\x20#%/:<>?@\[\\\]^|\x7f]", host):
            return None
        host = _ipv4(host) or host
    except (UnicodeError, ValueError):
        return None
    parts: list[str] = []
    steps = path.split("/")[1:] or [""]
    for k, step in enumerate(steps):
        last = k == len(steps) - 1
        if step.lower() in ("..", ".%2e", "%2e.", "%2e%2e"):
            parts = parts[:-1] + [""] * last
        elif step.lower() in (".", "%2e"):
            parts += [""] * last
        else:
            parts.append(step)
    safe = "!$&'()*+,;=:@/%[]|~^"
    path = quote("/" + "/".join(parts), safe=safe)
    query = quote(query, safe="!$&()*+,;=:@/?%[]|~^`{}\\") if query != "?" else "?"
    mark = quote(mark, safe="!$&'()*+,;=:@/?%[]|~^{}\\#") if mark else mark
    number_ = f":{int(port)}" if port and int(port) != DEFAULT_PORTS[scheme] else ""
    return f"{scheme}://{quote(user, safe='!$&()*+,:;=%') + '@' if user else ''}{host}{number_}{path}{query}{mark}"


@F.pandas_udf(StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    def one(text: str) -> str | None:
        url = canonical_url(text)
        return url if url and "." in re.match(r"https?://(?:[^/@]*@)?([^/:?#]*)", url)[1] else None

    return texts.map(one, na_action="ignore")


@inline
def site(raw: Column) -> Steps:
    """An address with a scheme and without one slash at its end. Only addresses beyond plain ASCII hosts and paths go to Python."""
    text = yield from clean.steps(raw)
    at = yield {"site": text}
    text = at["site"]
    at = yield {"none": ~text.rlike("[.:]") | text.rlike("(?iu)^нет(?=[A-Za-z0-9_])"), "whole": text.rlike("(?i)^https?://"), "misspelt": text.rlike(SCHEME_TYPO)}
    none, whole, typo = at["none"], at["whole"], ~at["whole"] & at["misspelt"]
    at = yield {"url": F.when(whole, text).when(typo, F.regexp_replace(text, "^[^:]*:/{0,2}", "http://")).otherwise(F.concat(F.lit("http://"), text))}
    url = at["url"]
    at = yield {"simple": url.rlike(SIMPLE_URL), "head": F.regexp_extract(url, "^[^/]*//[^/]*", 0)}
    simple, head = at["simple"], at["head"]
    plain = F.concat(F.lower(head), F.substring(url, F.length(head) + 1, F.length(url)))
    parsed = F.when(simple, plain).otherwise(_canonical(F.when(~none & ~simple, url)))
    at = yield {"value": F.when(~none, F.regexp_replace(parsed, "/$", ""))}
    value = at["value"]
    found = issues((~none & typo, "site_scheme_typo"), (~none & ~whole & ~typo, "site_scheme_missing"), (text.isNotNull() & value.isNull(), "site_not_a_url"))
    return result(value, found, "string")


# Cities

@inline
def nearest(value: Column, dictionary: list[str]) -> Steps:
    """The first of the entries nearest by edits to value (in lower case), within one edit up to six characters and two beyond."""
    if not dictionary:
        return F.lit(None).cast("string")
    words = F.array(*map(F.lit, dictionary))
    ranked = F.transform(words, lambda c, k: F.struct(F.levenshtein(value, F.lower(c)).alias("d"), k.alias("k"), c.alias("c")))
    at = yield {"best": F.array_min(ranked)}
    best = at["best"]
    return F.when(best["d"] <= F.when(F.length(value) <= 6, 1).otherwise(2), best["c"])


@inline
def city(raw: Column, dictionary: list[str]) -> Steps:
    """city as given, key as the dictionary spells it, issues. dictionary: the known cities, a small dimension, in the order that settles ties."""
    at = yield {"value": squeeze(raw), "given": raw.isNotNull() & (raw != "")}
    value, given = at["value"], at["given"]
    at = yield {"low": F.lower(value)}
    low = at["low"]
    exact = F.when(value.isin(*dictionary), value) if dictionary else F.lit(None).cast("string")
    first: dict[str, str] = {}
    for c in dictionary:
        first.setdefault(c.lower(), c)

    def lookup(table: dict[str, str]) -> Column:
        if not table:
            return F.lit(None).cast("string")
        return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[low]

    near = yield from nearest.steps(low, dictionary)
    at = yield {"exact": exact, "by_case": lookup(first), "alias": lookup(CITY_ALIASES), "near": near, "looks": value.rlike(ADDRESS)}
    exact, by_case, alias, near, looks = (at[k] for k in ("exact", "by_case", "alias", "near", "looks"))
    way = (
        F.when(~given, "city_missing").when(exact.isNotNull(), "").when(by_case.isNotNull(), "city_case_mismatch").when(alias.isNotNull(), "city_alias_or_translit")
        .when(looks, "city_looks_like_address").when(near.isNotNull(), "city_typo_fixed").otherwise("city_unknown")
    )
    at = yield {"way": way}
    way = at["way"]
    key = F.when(given & (way != "city_looks_like_address"), F.coalesce(exact, by_case, alias, near))
    found = F.array_compact(F.array(F.when(given & (value != raw), "city_whitespace"), F.when(way != "", way)))
    return F.struct(F.when(given & (way != "city_looks_like_address"), value).alias("city"), key.alias("key"), found.alias("issues"))


__all__ = ["BLANK", "canonical_url", "city", "issues", "nearest", "number", "phone", "rating", "reviews", "site"]
