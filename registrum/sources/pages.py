"""Paginated JSON exports: files page_N.json with an envelope and items."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "page string, per_page string, total string, items array<string>"


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """source_file, page, per_page, total, items (JSON texts; null where a file has no array), a row per file. Raises if no file fits the pattern."""
    files = page_files(spark, folder)
    if not files:
        raise FileNotFoundError(f"no pages in {folder}")
    return spark.read.schema(ENVELOPE).option("multiLine", True).json(files).select(F.col("_metadata.file_name").alias("source_file"), "*")


def page_files(spark: SparkSession, folder: str) -> list[str]:
    """The paths of the pages in a folder, in the order of their names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/page_*.json")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    return sorted(f.getPath().toString() for f in found if re.fullmatch(r"page_[0-9]+\.json", f.getPath().getName()))


def is_number(raw: Column, field: str) -> Column:
    """Whether a JSON text has a number, not a text, in the field."""
    return F.coalesce(F.schema_of_variant(F.variant_get(F.parse_json(raw), f"$.{field}", "variant")).rlike("INT|DECIMAL|DOUBLE|FLOAT"), F.lit(False))


def page_items(pages: DataFrame) -> DataFrame:
    """source_file, source_row (from 1), raw, fields (map of texts), rating_is_number, reviews_is_number: a row per item."""
    items = pages.select("source_file", F.posexplode("items").alias("place", "raw"))
    return items.select(
        "source_file",
        (F.col("place") + 1).alias("source_row"),
        "raw",
        F.from_json("raw", "map<string,string>").alias("fields"),
        is_number(F.col("raw"), "rating").alias("rating_is_number"),
        is_number(F.col("raw"), "reviews_count").alias("reviews_is_number"),
    )
