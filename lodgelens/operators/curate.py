"""Curation: raw listings / reviews -> dim_listing, dim_date, fact_reviews_stage.

All steps are declarative projections, one deterministic de-duplication per
table and one left-semi join, so Catalyst prunes columns down to what the
three outputs need and the job reads the raw input once.  Review texts are
kept out of every decision: which reviews stay is found from keys and dates.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelens.contracts import DIM_DATE, DIM_LISTING, FACT_REVIEWS_STAGE, conform
from lodgelens.functions import exprs as X
from lodgelens.operators.bitmap import semi_join
from lodgelens.operators.dedupe import ROW, dedupe_by_key


@dataclasses.dataclass(frozen=True)
class Place:
    """Where a raw drop's listings are; raw files don't say."""

    city: str = "London"
    state: str = "England"
    country: str = "UK"


def dedupe_in_plan(df: DataFrame, keys: list[str] | str, order_by: list[Column] | None = None) -> DataFrame:
    """``dedupe_by_key`` as one aggregate of a plan, for rows without long texts.

    A ``max`` over a struct of the row, reduced on the map side before the
    shuffle: a key holding a third of all rows becomes one row per map task,
    never one giant sort in a single task as a ``row_number`` window would.
    Runs no job of its own, but moves and sorts whole rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    order_by = list(order_by or [])
    rank_fields = [c.alias(f"_o{i}") for i, c in enumerate(order_by)]
    packed = F.struct(*rank_fields, *[F.col(c) for c in others]).alias("_row")
    best = df.select(*keys, packed).groupBy(*keys).agg(F.max("_row").alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def build_dim_date(dates: DataFrame, date_col: str = "review_date") -> DataFrame:
    """Calendar rows for the distinct dates present."""
    d = dates.select(F.col(date_col).alias("d")).where(F.col("d").isNotNull()).distinct()
    parts = X.date_parts(F.col("d"))
    return conform(d.select(*[v.alias(k) for k, v in parts.items()]), DIM_DATE)


def clean_listings(listings: DataFrame, place: Place = Place()) -> DataFrame:
    """Parse the raw (all-string) listing columns into typed curated columns."""
    present = set(listings.columns)  # one schema round trip

    def col_or_null(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("string")

    bath_text = col_or_null("bathrooms_text")
    cols = {
        "listing_id": col_or_null("listing_id").cast("string"),
        "host_id": X.parse_long(col_or_null("host_id")),
        "city": F.lit(place.city),
        "state": F.lit(place.state),
        "country": F.lit(place.country),
        "property_type": col_or_null("property_type"),
        "room_type": col_or_null("room_type"),
        "capacity": X.parse_int(col_or_null("accommodates")),
        "price": X.parse_price(col_or_null("price")),
        "bathrooms": X.parse_bathrooms(col_or_null("bathrooms"), bath_text),
        "bedrooms": X.parse_int(col_or_null("bedrooms")),
        "beds": X.parse_int(col_or_null("beds")),
        "neighbourhood_cleansed": col_or_null("neighbourhood_cleansed"),
        "neighbourhood_group_cleansed": col_or_null("neighbourhood_group_cleansed"),
        "latitude": X.parse_double(col_or_null("latitude")),
        "longitude": X.parse_double(col_or_null("longitude")),
        "host_is_superhost": X.parse_bool(col_or_null("host_is_superhost")),
        "host_response_time": col_or_null("host_response_time"),
        "host_response_rate": X.parse_percent(col_or_null("host_response_rate")),
        "host_acceptance_rate": X.parse_percent(col_or_null("host_acceptance_rate")),
        "instant_bookable": X.parse_bool(col_or_null("instant_bookable")),
        "amenities_count": X.amenities_count(col_or_null("amenities")),
        "review_scores_rating": X.parse_double(col_or_null("review_scores_rating")),
    }
    for name in ["minimum_nights", "maximum_nights", "availability_30", "availability_60",
                 "availability_90", "availability_365", "number_of_reviews",
                 "number_of_reviews_ltm", "number_of_reviews_l30d"]:
        cols[name] = X.parse_int(col_or_null(name))
    out = listings.select(*[v.alias(k) for k, v in cols.items()])
    return out.withColumn("price_bucket", X.price_bucket(F.col("price")))


def build_dim_listing(listings: DataFrame, loaded_at: _dt.datetime | None = None,
                      place: Place = Place()) -> DataFrame:
    """One curated row per listing (34 columns, contract ``DIM_LISTING``)."""
    clean = drop_null_keys(clean_listings(listings, place), ["listing_id"])
    one = dedupe_in_plan(clean, "listing_id")
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    return conform(one.withColumn("created_at", stamp), DIM_LISTING)


def parse_reviews(reviews: DataFrame) -> DataFrame:
    """Typed columns, valid date and non-null keys; review ids may repeat."""
    r = reviews.select(
        F.col("review_id").cast("string").alias("review_id"),
        F.col("listing_id").cast("string").alias("listing_id"),
        X.parse_date(F.col("date")).alias("review_date"),
        F.col("comments").cast("string").alias("comments"),
    )
    return drop_null_keys(r, ["listing_id", "review_id", "review_date"])


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Valid date, non-null keys, one row per review id (latest date wins)."""
    return dedupe_by_key(parse_reviews(reviews), "review_id", order_by=[F.col("review_date")])


def unwanted_reviews(rows: DataFrame, losers: DataFrame, dim_listing: DataFrame) -> DataFrame:
    """Numbers of the numbered reviews that lose to another of their id or whose listing isn't known.

    Found from narrow columns, so that one join drops both kinds and the texts
    are shuffled once, or not at all if the list is small enough to broadcast.
    """
    unknown = rows.select(ROW, "listing_id").join(dim_listing.select("listing_id"), "listing_id", "left_anti")
    return losers.select(ROW).union(unknown.select(ROW)).distinct()


def build_fact_stage(reviews_clean: DataFrame, dim_listing: DataFrame) -> DataFrame:
    """Reviews of known listings with date key, token count and a NULL rating.

    Reviews whose listing isn't in a bitmap of the known ones go before the
    texts are shuffled to the exact join.
    """
    return fact_stage(semi_join(reviews_clean, dim_listing, "listing_id"))


def fact_stage(reviews: DataFrame) -> DataFrame:
    """The stage columns of reviews that are known to stay."""
    f = reviews.select("review_id", "listing_id",
                       X.date_key(F.col("review_date")).alias("date_key"),
                       F.lit(None).cast("int").alias("rating"),
                       "comments",
                       X.token_count(F.col("comments")).alias("tokens_ct"))
    return conform(f, FACT_REVIEWS_STAGE)
