"""Raw records to companies, with the issues found on the way in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fields as fn
from ..functions.constants import RAW_FIELDS
from ..functions.steps import staged
from ..functions.text import clean, name_key, repair, strip

COMPANY = ("external_id", "name", "name_key", "category", "city", "city_key", "address", "rating", "reviews_count", "site", "phone", "phone_e164")


def spaced(fields: Column) -> Column:
    """<field>_whitespace for each text with white space at an end, in the record's order, unknown fields too."""
    found = F.filter(F.map_entries(fields), lambda e: e["value"] != strip(e["value"]))
    return F.transform(found, lambda e: F.concat(e["key"], F.lit("_whitespace")))


def normalize(rows: DataFrame, cities: list[str]) -> DataFrame:
    """rows (fields: map of texts, rating_is_number, reviews_is_number) with the company's columns, issues and rejected added.

    A record without id or name is rejected: its company's columns are null and only the issues up to that point are kept.
    cities: known spellings, a small dimension, in the order that settles ties of the nearest one.
    """
    r = rows.select("*", *[F.col("fields")[f].alias(f"_{f}") for f in RAW_FIELDS])
    texts = ("name", "category", "city", "address")
    r, at = staged(r, **{f"c_{f}": clean.steps(F.col(f"_{f}")) for f in ("id", *texts)})
    r = r.withColumns({"_id": at["c_id"], **{f"_{f}0": at[f"c_{f}"] for f in texts}})
    r, at = staged(r, **{f"r_{f}": repair.steps(F.col(f"_{f}0")) for f in texts})
    r = r.withColumns({f"_{f}1": at[f"r_{f}"] for f in texts})
    r, at = staged(
        r,
        town=fn.city.steps(F.col("_city1"), cities),
        rate=fn.rating.steps(F.col("_rating"), F.col("rating_is_number")),
        count=fn.reviews.steps(F.col("_reviews_count"), F.col("reviews_is_number")),
        web=fn.site.steps(F.col("_site")),
        tel=fn.phone.steps(F.col("_phone")),
    )
    r = r.withColumns({f"_{k}": c for k, c in at.items()})
    odd_id = ~F.col("_id").rlike(r"^c_[0-9]{6}\z")
    rated, counted = F.col("_rate.value"), F.col("_count.value")
    every = F.concat(
        fn.issues((odd_id, "id_unexpected_format"), (F.col("_name1") != F.col("_name0"), "name_mojibake_repaired"), (F.col("_category1").isNull(), "category_missing")),
        spaced(F.col("fields")),
        fn.issues((F.col("_city1") != F.col("_city0"), "city_mojibake_repaired")),
        F.col("_town.issues"),
        fn.issues((F.col("_address1").isNull(), "address_missing")),
        F.col("_rate.issues"),
        F.col("_count.issues"),
        F.col("_web.issues"),
        F.col("_tel.issues"),
        fn.issues((rated.isNull() & (counted > 0), "rating_missing_with_reviews"), (rated.isNotNull() & (counted == 0), "rating_without_reviews")),
    )
    no_id, no_name = F.col("_id").isNull(), F.col("_name0").isNull()
    found = F.when(no_id, F.array(F.lit("id_missing"))).when(no_name, F.concat(fn.issues((odd_id, "id_unexpected_format")), F.array(F.lit("name_missing")))).otherwise(every)
    kept = ~no_id & ~no_name
    values = (F.col("_id"), F.col("_name1"), name_key(F.col("_name1")), F.col("_category1"), F.col("_town.city"), F.col("_town.key"), F.col("_address1"), rated, counted, F.col("_web.value"), F.col("_tel.phone"), F.col("_tel.e164"))
    return r.select(*rows.columns, *[F.when(kept, v).alias(n) for n, v in zip(COMPANY, values, strict=True)], found.alias("issues"), (~kept).alias("rejected"))
