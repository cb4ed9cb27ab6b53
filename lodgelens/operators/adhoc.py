"""Ad-hoc exploration queries over the curated tables, as DataFrame functions.

Each cell of the exploration notebook becomes a function returning a
DataFrame (the notebook's ``show(10)`` is display only, so results are
whole).  Names follow the curated schema.
"""

from __future__ import annotations

import uuid

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelens.functions import exprs as X
from lodgelens.operators import bitmap
from lodgelens.operators.analysis import register_views
from lodgelens.operators.joins import salted_join


def filter_column_vs_column(listings: DataFrame) -> DataFrame:
    """Listings with more bathrooms than bedrooms (NULL on either side drops)."""
    return (listings.where(F.col("bathrooms") > F.col("bedrooms"))
            .select("listing_id", "bathrooms", "bedrooms"))


def filter_price_over(listings: DataFrame, threshold: float = 5000) -> DataFrame:
    return listings.where(F.col("price") > threshold).select("listing_id", "price")


def filter_conjunction(listings: DataFrame, max_price: float = 150, min_reviews: int = 20,
                       min_rating: float = 4.5) -> DataFrame:
    return (listings.where((F.col("price") < max_price)
                           & (F.col("number_of_reviews") > min_reviews)
                           & (F.col("review_scores_rating") > min_rating))
            .select("listing_id", "price", "number_of_reviews", "review_scores_rating"))


def filter_disjunction(listings: DataFrame, max_price: float = 150, min_bedrooms: int = 1) -> DataFrame:
    return (listings.where((F.col("price") < max_price) | (F.col("bedrooms") > min_bedrooms))
            .select("listing_id", "price", "bedrooms"))


def max_price(listings: DataFrame) -> DataFrame:
    return listings.agg(F.max("price").alias("max_price"))


def distinct_hosts(listings: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct hosts; a NULL host counts as one value (as
    ``distinct().count()`` does).  ``approximate`` switches to HyperLogLog++
    for very large inputs (NULL then does not count)."""
    if approximate:
        return listings.agg(F.approx_count_distinct("host_id").alias("n_hosts"))
    return listings.select("host_id").distinct().agg(F.count(F.lit(1)).alias("n_hosts"))


def host_stats(listings: DataFrame) -> DataFrame:
    """Per host: listings with a rating and their mean rating."""
    return (listings.where(F.col("review_scores_rating").isNotNull())
            .groupBy("host_id")
            .agg(F.count("host_id").alias("total_listings"),
                 F.avg("review_scores_rating").alias("average_review_score")))


def reviews_per_listing(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("listing_id").agg(F.count(F.lit(1)).alias("count"))


def top_reviewed_listings(reviews: DataFrame, n: int = 10) -> DataFrame:
    return (reviews_per_listing(reviews)
            .orderBy(F.desc("count"), F.asc_nulls_last("listing_id")).limit(n))


def join_listing_reviews(listings: DataFrame, reviews: DataFrame,
                         salt_buckets: int | None = None) -> DataFrame:
    """Listings with their review ids and comments (inner equi-join).

    ``salt_buckets`` spreads hot listings over that many tasks explicitly
    (``joins.salted_join``); by default AQE splits skewed partitions.
    """
    r = reviews.select("listing_id", "review_id", "comments")
    if salt_buckets:
        j = salted_join(r, listings.select("listing_id"), "listing_id", "inner", salt_buckets)
    else:
        j = listings.select("listing_id").join(r, "listing_id")
    return j.select("listing_id", "review_id", "comments")


def join_sql_inner(spark: SparkSession, listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """The same inner join written in Spark SQL over registered temp views.

    View names carry a unique suffix so concurrent callers in one session do
    not replace each other's views.
    """
    suffix = uuid.uuid4().hex[:8]
    r_name, l_name = register_views({f"reviews_{suffix}": reviews, f"listings_{suffix}": listings})
    return spark.sql(
        f"SELECT r.listing_id, r.review_id, length(r.comments) AS comment_length "
        f"FROM {r_name} r JOIN {l_name} l ON r.listing_id = l.listing_id")


def anti_join_unreviewed(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Listings that have no review.

    The review side is reduced to its distinct keys first (map-side), so a
    listing with millions of reviews ships one key per task, not millions.
    """
    reviewed = reviews.select("listing_id").distinct()
    return listings.select("listing_id").join(reviewed, "listing_id", "left_anti")


def semi_join_known_listings(reviews: DataFrame, listings: DataFrame,
                             salt_buckets: int | None = None) -> DataFrame:
    """Reviews whose listing exists (``salt_buckets`` as in ``join_listing_reviews``).

    A bitmap of the listing ids drops most reviews without one before the
    others meet the listings.
    """
    if salt_buckets:
        return salted_join(reviews, listings.select("listing_id"), "listing_id", "left_semi", salt_buckets)
    return bitmap.semi_join(reviews, listings, "listing_id")


def price_category_counts(listings: DataFrame) -> DataFrame:
    """Listings per Budget / Mid-range / Luxury category of known prices."""
    return (listings.where(F.col("price").isNotNull())
            .groupBy(X.price_category(F.col("price")).alias("price_category"))
            .agg(F.count(F.lit(1)).alias("count")))


def comment_length_by_listing(spark: SparkSession, reviews: DataFrame, listings: DataFrame,
                              min_reviews: int = 5) -> DataFrame:
    """Mean comment length and review count per listing (>= ``min_reviews``),
    longest first; Spark SQL over the two DataFrames.

    Reviews are summed per listing before they meet the listings (a semi
    join on unique listing ids), so a hot listing is reduced map-side and
    the join is one row per listing.
    """
    return spark.sql(
        "WITH per AS (SELECT listing_id, SUM(LENGTH(comments)) AS len_sum, "
        "COUNT(LENGTH(comments)) AS len_n, COUNT(review_id) AS reviews_count "
        "FROM {reviews} GROUP BY listing_id) "
        "SELECT p.listing_id, try_divide(p.len_sum, p.len_n) AS average_comment_length, p.reviews_count "
        "FROM per p LEFT SEMI JOIN {listings} l ON p.listing_id = l.listing_id "
        "WHERE p.reviews_count >= {min_reviews} "
        "ORDER BY average_comment_length DESC, p.listing_id",
        reviews=reviews, listings=listings, min_reviews=min_reviews)


def listing_age_by_host(listings: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per host: mean whole days from each listing's first review to ``as_of`` (default: today).

    A built-in ``avg(datediff)``: partial aggregation on the map side, no
    Python worker (the notebook used a grouped-aggregate pandas UDF).
    """
    return (listings.where(F.col("first_review").isNotNull())
            .groupBy("host_id")
            .agg(F.avg(X.days_since(F.col("first_review"), as_of or _dt.date.today()))
                 .alias("average_days_since_first_review_days")))
