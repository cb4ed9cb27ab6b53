"""Table contracts: the column names and types of the curated/warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

DIM_LISTING = T.StructType([
    T.StructField("listing_id", S), T.StructField("host_id", L),
    T.StructField("city", S), T.StructField("state", S), T.StructField("country", S),
    T.StructField("property_type", S), T.StructField("room_type", S),
    T.StructField("capacity", I), T.StructField("price", D), T.StructField("price_bucket", S),
    T.StructField("bathrooms", D), T.StructField("bedrooms", I), T.StructField("beds", I),
    T.StructField("neighbourhood_cleansed", S), T.StructField("neighbourhood_group_cleansed", S),
    T.StructField("latitude", D), T.StructField("longitude", D),
    T.StructField("minimum_nights", I), T.StructField("maximum_nights", I),
    T.StructField("availability_30", I), T.StructField("availability_60", I),
    T.StructField("availability_90", I), T.StructField("availability_365", I),
    T.StructField("number_of_reviews", I), T.StructField("number_of_reviews_ltm", I),
    T.StructField("number_of_reviews_l30d", I),
    T.StructField("review_scores_rating", D), T.StructField("host_is_superhost", B),
    T.StructField("host_response_time", S), T.StructField("host_response_rate", D),
    T.StructField("host_acceptance_rate", D), T.StructField("instant_bookable", B),
    T.StructField("amenities_count", I), T.StructField("created_at", T.TimestampType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", I), T.StructField("yyyy", I), T.StructField("mm", I),
    T.StructField("dd", I), T.StructField("dow", I), T.StructField("is_weekend", B),
])

FACT_REVIEWS_STAGE = T.StructType([
    T.StructField("review_id", S), T.StructField("listing_id", S), T.StructField("date_key", I),
    T.StructField("rating", I), T.StructField("comments", S), T.StructField("tokens_ct", I),
])

# Scored rows carry ``rating`` through (the warehouse load lists it).
FACT_REVIEWS = T.StructType(FACT_REVIEWS_STAGE.fields + [
    T.StructField("sentiment_label", S), T.StructField("sentiment_score", D),
])

CONTRACTS = {
    "dim_listing": DIM_LISTING,
    "dim_date": DIM_DATE,
    "fact_reviews_stage": FACT_REVIEWS_STAGE,
    "fact_reviews": FACT_REVIEWS,
}

PRIMARY_KEYS = {
    "dim_listing": "listing_id",
    "dim_date": "date_key",
    "fact_reviews_stage": "review_id",
    "fact_reviews": "review_id",
}


def conform_columns(df: DataFrame, schema: T.StructType, strict: bool = False) -> list:
    """The contract's columns as expressions over ``df`` (see ``conform``)."""
    have = {f.name: f.dataType for f in df.schema.fields}  # one schema round trip
    wrong = {f.name: f"{have[f.name].simpleString()}, not {f.dataType.simpleString()}"
             for f in schema.fields if strict and f.name in have and have[f.name] != f.dataType}
    if wrong:
        raise TypeError(f"columns break the contract: {wrong}")
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
            c = c if have[f.name] == f.dataType else c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return cols


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Select exactly the contract's columns, in order, with its types.

    Missing columns become typed NULLs (the load of a column that the writer
    did not produce, e.g. ``rating``); extra columns are dropped.  Casts are
    ``try_cast`` so a bad value is NULL, never a failed job; ``strict``
    refuses a column of another type instead of casting it.
    """
    return df.select(*conform_columns(df, schema, strict))
