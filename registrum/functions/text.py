"""Texts: white space, empty markers, broken encodings, keys of names."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .constants import BROKEN_PAIR, EMPTY_MARKERS, LEGAL_FORMS, QUOTES, SPACES
from .steps import Steps, inline

BLANK = f"[{SPACES}]"


def strip(c: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{BLANK}+", " "))


def is_empty_marker(c: Column) -> Column:
    return F.lower(c).isin(*EMPTY_MARKERS)


@inline
def clean(c: Column) -> Steps:
    """The squeezed text, or null for a marker of a missing value."""
    at = yield {"text": squeeze(c.cast("string"))}
    return F.when(~is_empty_marker(at["text"]), at["text"])


def suspicion(c: Column) -> Column:
    """Pairs that only a wrong decoding makes."""
    return F.regexp_count(c, F.lit(BROKEN_PAIR))


_pair = re.compile(BROKEN_PAIR)


def recode(text: str | None) -> str | None:
    """UTF-8 that was read as windows-1251, read rightly; else the text itself."""
    if not text or not (before := len(_pair.findall(text))):
        return text
    try:
        again = text.encode("cp1251").decode("utf-8")
    except UnicodeError:
        return text
    better = "\ufffd" not in again and re.search("[а-яёА-ЯЁ]", again) and len(_pair.findall(again)) < before
    return again if better else text


@F.pandas_udf(StringType())
def _recoded(texts: pd.Series) -> pd.Series:
    return texts.map(recode, na_action="ignore")


@inline
def repair(c: Column) -> Steps:
    """Texts with suspicious pairs, recoded where that makes them better. Only such texts reach Python's result."""
    at = yield {"broken": suspicion(c) > 0}
    return F.when(at["broken"], _recoded(F.when(at["broken"], c))).otherwise(c)


def name_key(c: Column) -> Column:
    """The name in lower case without quotes and one legal form in front, for comparison."""
    plain = F.translate(F.lower(c), QUOTES, " " * len(QUOTES))
    bare = F.regexp_replace(plain, rf"^({'|'.join(LEGAL_FORMS)})(?![а-яё])\.?{BLANK}*", "")
    return squeeze(bare)
