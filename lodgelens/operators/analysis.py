"""Warehouse analyses and views over the curated star schema.

Inputs are the curated DataFrames: ``dim_listing`` (one row per listing),
``fact_reviews`` (one row per scored review) and ``dim_date`` (one row per
calendar day).

Scale notes
-----------
* Most fact-level questions are answered by first reducing the fact table to
  one row per listing with ``listing_partials``.  That aggregate runs map-side
  before the shuffle, so a listing that holds a third of all reviews collapses
  to one row per map task, and the later join to ``dim_listing`` is one-to-one
  with no skew.  ``vw_city_sentiment_daily`` joins the fact's narrow rows
  instead, as reviews by listing and day are about as many as reviews; the view
  that is kept by day (``rollups``) counts by listing and day first.
* Nothing is broadcast by hint; AQE turns a join into a broadcast at run time
  only when the measured side is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (see ``session``).
* Every top-k ends with a unique key in the ordering, so LIMIT returns the
  same rows on every run; Spark plans it as TakeOrderedAndProject.
* Reported rounded metrics use ``round_half_up`` (see functions.exprs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelens.functions import exprs as X
from lodgelens.operators.percentiles import exact_percentiles

POSITIVE = "POSITIVE"


def _n() -> Column:
    return F.count(F.lit(1))


def listing_partials(fact: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """Per listing (and ``extra_keys``): reviews, positive reviews, score sum and count.

    The sums are additive, so later levels (city, band, day) combine them
    exactly; this is the pre-aggregation that keeps hot listings cheap.
    """
    keys = ["listing_id"] + list(extra_keys or [])
    return fact.groupBy(*keys).agg(
        _n().alias("n_reviews"),
        F.sum(F.when(F.col("sentiment_label") == POSITIVE, 1).otherwise(0)).alias("n_positive"),
        F.sum("sentiment_score").alias("score_sum"),
        F.count("sentiment_score").alias("score_n"),
    )


def _rates(n="n_reviews", pos="n_positive", ssum="score_sum", sn="score_n") -> dict[str, Column]:
    return {
        "positive_rate": X.safe_ratio(F.col(pos), F.col(n)),
        "avg_conf": X.safe_ratio(F.col(ssum), F.col(sn)),
    }


# --------------------------------------------------------------- listing-only

def supply_mix(dim_listing: DataFrame) -> DataFrame:
    """Listings by room type x price band."""
    return (dim_listing.groupBy("room_type", "price_bucket")
            .agg(_n().alias("listings"))
            .orderBy(F.asc_nulls_last("room_type"), F.asc_nulls_last("price_bucket")))


def price_landscape(dim_listing: DataFrame, approximate: bool = False,
                    accuracy: int = 10000) -> DataFrame:
    """Per property type: listings, mean, median and p90 of known prices.

    Median and p90 are exact and interpolated (PERCENTILE_CONT), found by
    counts over ranges of prices (``percentiles``), so a type may have any
    number of distinct prices; finding them runs jobs.  ``approximate`` opts
    into ``percentile_approx`` (a fixed-size sketch per type, returns an
    observed value within 1/accuracy of the rank).
    """
    if approximate:
        q = F.percentile_approx("price", [0.5, 0.9], accuracy)
        per = (dim_listing.where(F.col("price").isNotNull()).groupBy("property_type")
               .agg(_n().alias("n"), F.sum("price").alias("total"), q.getItem(0).alias("median"), q.getItem(1).alias("p90")))
    else:
        per = exact_percentiles(dim_listing, "property_type", "price", {"median": 0.5, "p90": 0.9})
    return (per.select("property_type", F.col("n").alias("listings"),
                       X.round_half_up(F.col("total") / F.col("n"), 2).alias("avg_price"),
                       X.round_half_up(F.col("median"), 2).alias("median_price"),
                       X.round_half_up(F.col("p90"), 2).alias("p90_price"))
            .orderBy(F.desc("listings"), F.asc_nulls_last("property_type")))


def top_neighbourhoods(dim_listing: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` neighbourhoods with the most listings (ties by name)."""
    return (dim_listing.groupBy("neighbourhood_cleansed")
            .agg(_n().alias("listings"))
            .orderBy(F.desc("listings"), F.asc_nulls_last("neighbourhood_cleansed"))
            .limit(n))


def superhost_compare(dim_listing: DataFrame) -> DataFrame:
    """Listings, mean price and mean rating by superhost flag (NULL is a group)."""
    return (dim_listing.groupBy("host_is_superhost")
            .agg(_n().alias("listings"),
                 X.round_half_up(F.avg("price"), 2).alias("avg_price"),
                 X.round_half_up(F.avg("review_scores_rating"), 2).alias("avg_rating"))
            .orderBy(F.desc_nulls_first("host_is_superhost")))


def instant_book_compare(dim_listing: DataFrame) -> DataFrame:
    """Listings and mean rating by instant-bookable flag."""
    return (dim_listing.groupBy("instant_bookable")
            .agg(_n().alias("listings"),
                 X.round_half_up(F.avg("review_scores_rating"), 2).alias("avg_rating"))
            .orderBy(F.desc_nulls_first("instant_bookable")))


def availability_signal(dim_listing: DataFrame, min_listings: int = 50, n: int = 20) -> DataFrame:
    """Neighbourhoods with the most 30-day availability (>= ``min_listings``)."""
    return (dim_listing.groupBy("neighbourhood_cleansed")
            .agg(X.round_half_up(F.avg("availability_30"), 1).alias("avg_avail_30"),
                 _n().alias("listings"))
            .where(F.col("listings") >= min_listings)
            .orderBy(F.desc("avg_avail_30"), F.asc_nulls_last("neighbourhood_cleansed"))
            .limit(n))


def value_picks(dim_listing: DataFrame, low: float = 60, high: float = 150,
                min_rating: float = 4.8, n: int = 50) -> DataFrame:
    """Cheap, highly rated listings: best rating first, then cheapest."""
    return (dim_listing
            .where(F.col("price").between(low, high) & (F.col("review_scores_rating") >= min_rating))
            .select("listing_id", "price", "review_scores_rating")
            .orderBy(F.desc("review_scores_rating"), F.asc("price"), F.asc("listing_id"))
            .limit(n))


# ------------------------------------------------------------------ fact-side

def reviews_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Review volume by year and month (fact joined to the calendar)."""
    per_day = fact.groupBy("date_key").agg(_n().alias("n"))
    cal = dim_date.select("date_key", "yyyy", "mm")
    return (per_day.join(cal, "date_key")
            .groupBy("yyyy", "mm").agg(F.sum("n").alias("reviews"))
            .orderBy("yyyy", "mm"))


def sentiment_split(fact: DataFrame) -> DataFrame:
    """Reviews per sentiment label."""
    return (fact.groupBy("sentiment_label").agg(_n().alias("reviews"))
            .orderBy(F.desc("reviews"), F.asc_nulls_last("sentiment_label")))


def _with_listing(partials: DataFrame, dim_listing: DataFrame, cols: list[str]) -> DataFrame:
    return partials.join(dim_listing.select("listing_id", *cols), "listing_id")


def sentiment_by_city(fact: DataFrame, dim_listing: DataFrame, min_reviews: int = 200) -> DataFrame:
    """Reviews, positive rate and mean confidence per city (>= ``min_reviews``)."""
    parts = _with_listing(listing_partials(fact), dim_listing, ["city"])
    agg = parts.groupBy("city").agg(
        F.sum("n_reviews").alias("reviews"), F.sum("n_positive").alias("pos"),
        F.sum("score_sum").alias("ssum"), F.sum("score_n").alias("sn"))
    r = _rates("reviews", "pos", "ssum", "sn")
    return (agg.where(F.col("reviews") >= min_reviews)
            .select("city", "reviews",
                    X.round_half_up(r["positive_rate"], 3).alias("positive_rate"),
                    X.round_half_up(r["avg_conf"], 3).alias("avg_conf"))
            .orderBy(F.desc("positive_rate"), F.asc_nulls_last("city")))


def sentiment_by_price_band(fact: DataFrame, dim_listing: DataFrame) -> DataFrame:
    """Reviews and positive rate by the price band recomputed from price."""
    parts = _with_listing(listing_partials(fact), dim_listing, ["price"])
    agg = (parts.withColumn("price_bucket_calc", X.price_bucket(F.col("price")))
           .groupBy("price_bucket_calc")
           .agg(F.sum("n_reviews").alias("reviews"), F.sum("n_positive").alias("pos")))
    return (agg.select("price_bucket_calc", "reviews",
                       X.round_half_up(X.safe_ratio(F.col("pos"), F.col("reviews")), 3)
                        .alias("positive_rate"))
            .orderBy("price_bucket_calc"))


def best_worst_listings(fact: DataFrame, min_reviews: int = 20, n: int = 10) -> DataFrame:
    """Top and bottom ``n`` listings by positive rate among those with
    >= ``min_reviews`` reviews.  Both ends rank on the raw rate, then review
    count (desc), then listing id; the reported rate is rounded to 3."""
    agg = (listing_partials(fact)
           .where(F.col("n_reviews") >= min_reviews)
           .select("listing_id", "n_reviews",
                   X.safe_ratio(F.col("n_positive"), F.col("n_reviews")).alias("rate")))
    top = (agg.orderBy(F.desc("rate"), F.desc("n_reviews"), F.asc("listing_id")).limit(n)
           .withColumn("band", F.lit("TOP")))
    bottom = (agg.orderBy(F.asc("rate"), F.desc("n_reviews"), F.asc("listing_id")).limit(n)
              .withColumn("band", F.lit("BOTTOM")))
    out = top.unionByName(bottom)
    return out.select("band", "listing_id", "n_reviews",
                      X.round_half_up(F.col("rate"), 3).alias("positive_rate"))


# ---------------------------------------------------------------------- views

def vw_listing_sentiment(fact: DataFrame) -> DataFrame:
    """Per listing: reviews, positive rate, mean confidence (unrounded)."""
    p = listing_partials(fact)
    r = _rates()
    return p.select("listing_id", F.col("n_reviews").alias("reviews"),
                    r["positive_rate"].alias("positive_rate"), r["avg_conf"].alias("avg_conf"))


def vw_city_sentiment_daily(fact: DataFrame, dim_listing: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per day and city: reviews and positive rate."""
    # a listing has about one review a day, so counting by listing and day first
    # would reduce nothing: attach the city, then count by day and city map-side
    with_city = _with_listing(fact.select("listing_id", "date_key", "sentiment_label"), dim_listing, ["city"])
    parts = with_city.groupBy("date_key", "city").agg(
        _n().alias("n_reviews"), F.count_if(F.col("sentiment_label") == "POSITIVE").alias("n_positive"))
    cal = dim_date.select("date_key", "yyyy", "mm", "dd")
    agg = (parts.join(cal, "date_key")
           .groupBy("yyyy", "mm", "dd", "city")
           .agg(F.sum("n_reviews").alias("reviews"), F.sum("n_positive").alias("pos")))
    return agg.select("yyyy", "mm", "dd", "city", "reviews",
                      X.safe_ratio(F.col("pos"), F.col("reviews")).alias("positive_rate"))


def listing_kpi_attach(dim_listing: DataFrame, fact: DataFrame, n: int = 50) -> DataFrame:
    """Listings with their sentiment KPIs attached (left join), best rate first."""
    s = vw_listing_sentiment(fact)
    j = dim_listing.select("listing_id", "city", "price", "review_scores_rating") \
        .join(s, "listing_id", "left")
    return (j.orderBy(F.desc_nulls_last("positive_rate"), F.asc("listing_id")).limit(n)
            .select("listing_id", "city", "price", "review_scores_rating",
                    F.col("reviews").alias("reviews_scored"),
                    X.round_half_up(F.col("positive_rate"), 3).alias("positive_rate"),
                    X.round_half_up(F.col("avg_conf"), 3).alias("avg_conf")))


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Expose DataFrames to ``spark.sql`` as temp views; returns the names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)
