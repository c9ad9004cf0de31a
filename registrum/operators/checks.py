"""Checks of a paginated export and small relational patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def envelope_problems(pages: DataFrame) -> DataFrame:
    """problem, source_file (null for those of all pages): files without items, odd page numbers or sizes, differing totals, a break in 1..n."""
    whole = F.col("page").rlike("^-?[0-9]+$")
    sound = pages.filter("items is not null")
    each = sound.select("source_file", F.explode(F.array_compact(F.array(F.when(~F.coalesce(whole, F.lit(False)), F.concat(F.lit("page = "), F.coalesce("page", F.lit("null")))), F.when(~F.size("items").cast("string").eqNullSafe(F.col("per_page")), F.concat(F.lit("items = "), F.size("items"), F.lit(", per_page = "), F.coalesce("per_page", F.lit("null"))))))).alias("problem"))
    none = pages.filter("items is null").select("source_file", F.lit("no items array").alias("problem"))
    totals = sound.agg(F.sort_array(F.collect_set("total")).alias("t")).filter(F.size("t") > 1).select(F.lit(None).cast("string").alias("source_file"), F.concat(F.lit("totals differ: "), F.array_join("t", ", ")).alias("problem"))
    # Numbers are 1 to n if they are whole, differ, and the least is 1 and the greatest n; no order over all pages is needed.
    number = sound.select(F.col("page").try_cast("long").alias("n"))
    ends = number.agg(F.count("*").alias("c"), F.count_distinct("n").alias("d"), F.min("n").alias("low"), F.max("n").alias("high"))
    broken = ends.filter("c > 0 and not (c = d and low = 1 and high = c)")
    gap = broken.select(F.lit(None).cast("string").alias("source_file"), F.concat_ws("", F.lit("page numbers are not 1 to "), F.col("c").cast("string")).alias("problem"))
    return none.unionByName(each).unionByName(totals).unionByName(gap)


def repeated(df: DataFrame, key: str) -> DataFrame:
    """key, rows: values that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")


def gaps(df: DataFrame, number: str) -> DataFrame:
    """missing: whole numbers from 1 to the greatest that do not occur. Found between neighbours, so the range itself is never built."""
    present = df.select(F.col(number).cast("long").alias("n")).filter("n > 0").distinct()
    # Neighbours within spans of a million are found span by span; the first of a span looks at the last one of the spans before.
    spans = present.withColumn("span", F.expr("n div 1000000"))
    last = spans.groupBy("span").agg(F.max("n").alias("top")).withColumn("before", F.coalesce(F.max("top").over(W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = spans.withColumn("low", F.lag("n").over(W.partitionBy("span").orderBy("n"))).join(last.select("span", "before"), "span")
    edges = inside.select(F.coalesce("low", "before").alias("low"), "n").filter("n - low > 1")
    # A gap is cut into parts of a million numbers, each of which becomes rows by itself.
    starts = edges.select((F.col("low") + 1).alias("a"), (F.col("n") - 1).alias("b"))
    starts = starts.select("b", F.col("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(b - a) div 1000000"))).alias("k"))
    starts = starts.select((F.col("a") + F.col("k") * 1_000_000).alias("a"), F.least("b", F.col("a") + (F.col("k") + 1) * 1_000_000 - 1).alias("b"))
    return starts.select(F.explode(F.sequence("a", "b")).alias("missing"))


def first_seen(df: DataFrame, value: str, *order: str) -> DataFrame:
    """value, first: distinct values with the least of the order columns at which they occur."""
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(F.struct(*order)).alias("first"))


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, by a minimum over the row's columns and so with partial aggregation."""
    rest = [c for c in df.columns if c not in key and c not in order]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("r"))
    return best.select(*[F.col(c) if c in key else F.col(f"r.{c}") for c in df.columns])


def issue_histogram(rows: DataFrame, column: str = "issues") -> DataFrame:
    return rows.select(F.explode(column).alias("issue")).groupBy("issue").agg(F.count("*").alias("rows"))
