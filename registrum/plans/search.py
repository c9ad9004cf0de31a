"""Search, filter and pages over the companies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_SIZE = 50


def escape_like(text: str) -> str:
    """Text that LIKE takes literally, with a backslash as escape."""
    return "".join("\\" + c if c in "\\%_" else c for c in text)


def first_value(value: str | list[str] | None) -> str | None:
    """Of a parameter that is given several times the first."""
    return (value[0] if value else None) if isinstance(value, list) else value


def page_number(value: str | list[str] | None) -> int:
    """A page from 1; 1 for what is no number."""
    try:
        return max(1, int(float(first_value(value) or 1)))
    except (ValueError, OverflowError):
        return 1


@dataclass
class Page:
    rows: DataFrame
    total: int
    page: int
    pages: int
    cities: DataFrame


def search(companies: DataFrame, text: str | None = None, city: str | None = None, category: str | None = None, page: int = 1, size: int = PAGE_SIZE) -> Page:
    """Companies whose name has the text in any case, of a city and a category where given; the best rated first and unrated ones last, among
    equals those with unknown counts of reviews before the most reviewed. A page beyond the last is the last."""
    found = companies
    text, city, category = (x.strip() if x else None for x in (text, city, category))
    if text:
        found = found.filter(F.col("name").ilike(f"%{escape_like(text)}%"))
    if city:
        found = found.filter(F.col("city_key") == city)
    if category:
        found = found.filter(F.col("category") == category)
    total = found.count()
    pages = max(1, -(-total // size))
    page = min(max(1, page), pages)
    rows = found.orderBy(F.desc_nulls_last("rating"), F.desc_nulls_first("reviews_count"), "external_id").offset((page - 1) * size).limit(size)
    cities = companies.filter("city_key is not null").groupBy("city_key").agg(F.count("*").alias("companies")).orderBy(F.desc("companies"), "city_key")
    return Page(rows, total, page, pages, cities)


def display(rows: DataFrame) -> DataFrame:
    """Texts as a page shows them: a dash for what is unknown, addresses without their scheme."""
    shown = rows.withColumn("site", F.regexp_replace("site", "^https?://", ""))
    return shown.select(*[F.coalesce(F.col(c).cast("string"), F.lit("—")).alias(c) for c in rows.columns])
