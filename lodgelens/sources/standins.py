"""Map the driver's tables onto the listings / reviews shape.

The mart's operators take curated DataFrames (``dim_listing``,
``fact_reviews``, ``dim_date``).  The test and bench data are TPC-H-like
tables, so each operator runs on a stand-in derived from them by plain
projections (and, for ``city``, a join to ``nation``).  Every double in the
stand-ins is a multiple of a power of two (0.5, 0.25, 1/16) so sums are
exact and results do not depend on summation order or partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelens.contracts import DIM_LISTING
from lodgelens.functions import exprs as X
from lodgelens.session import table_path

# The constant location columns the curation job writes.
DEFAULT_CITY = "London"
DEFAULT_STATE = "England"
DEFAULT_COUNTRY = "UK"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# The part -> listing projection, as SQL expressions in contract order.  One
# ``selectExpr`` is parsed in the JVM in a single pass, which keeps planning
# cheap (each DataFrame-API call is a round trip from Python).
_PART_LISTING_EXPRS = [
    "CAST(p_partkey AS STRING) AS listing_id",
    "p_partkey % 100 AS host_id",
    f"'{DEFAULT_STATE}' AS state",
    f"'{DEFAULT_COUNTRY}' AS country",
    "p_type AS property_type",
    "p_type AS room_type",
    "p_size % 8 + 1 AS capacity",
    "CAST(CAST(round(p_retailprice * 10) AS BIGINT) - 9000 AS DOUBLE) * 0.5D AS price",
    "CAST(p_size % 7 AS DOUBLE) * 0.5D AS bathrooms",
    "p_size % 5 AS bedrooms",
    "p_size % 4 + 1 AS beds",
    "p_brand AS neighbourhood_cleansed",
    "p_type AS neighbourhood_group_cleansed",
    "51.25D + CAST(p_partkey % 64 AS DOUBLE) * 0.0078125D AS latitude",
    "-0.5D + CAST(p_partkey % 128 AS DOUBLE) * 0.0078125D AS longitude",
    "p_size % 7 + 1 AS minimum_nights",
    "365 AS maximum_nights",
    "p_size % 31 AS availability_30",
    "p_size % 61 AS availability_60",
    "p_size % 91 AS availability_90",
    "(p_size * 7) % 366 AS availability_365",
    "p_size AS number_of_reviews",
    "p_size % 13 AS number_of_reviews_ltm",
    "p_size % 3 AS number_of_reviews_l30d",
    "1.0D + CAST(p_size % 17 AS DOUBLE) * 0.25D AS review_scores_rating",
    "CASE WHEN p_size % 7 = 0 THEN CAST(NULL AS BOOLEAN) ELSE p_size % 2 = 0 END AS host_is_superhost",
    "'within a day' AS host_response_time",
    "CAST((p_size * 2) % 101 AS DOUBLE) AS host_response_rate",
    "CAST((p_size * 3) % 101 AS DOUBLE) AS host_acceptance_rate",
    "p_partkey % 3 = 0 AS instant_bookable",
    "size(split(p_name, ' ')) AS amenities_count",
    "CAST(NULL AS TIMESTAMP) AS created_at",
    "CAST(p_partkey % 25 AS INT) AS _city_key",
]
_LISTING_ORDER = [f.name for f in DIM_LISTING.fields]


def listings_from_part(spark: SparkSession, sf_dir: str, with_city: bool = False) -> DataFrame:
    """``dim_listing``-shaped stand-in: one listing per part.

    listing_id = p_partkey; host = p_partkey % 100; room/property type = p_type;
    neighbourhood = p_brand; price = (p_retailprice*10 - 9000) / 2 (0..499.5, all
    five bands); rating in quarter steps 1..5; superhost NULL for p_size % 7 = 0.
    ``with_city`` names the city after nation ``p_partkey % 25`` (25 cities).
    """
    df = read_table(spark, sf_dir, "part").selectExpr(*_PART_LISTING_EXPRS)
    df = df.withColumn("price_bucket", X.price_bucket(F.col("price")))
    if with_city:
        nation = read_table(spark, sf_dir, "nation").selectExpr(
            "n_nationkey AS _city_key", "n_name AS city")
        df = df.join(nation, "_city_key", "left")
    else:
        df = df.withColumn("city", F.lit(DEFAULT_CITY))
    return df.select(*_LISTING_ORDER)


def listings_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second listing stand-in: one listing per order, host = customer.

    The price goes through the money parser from a formatted string
    ('$123,456.78'), and ``first_review`` is the order date.
    """
    o = read_table(spark, sf_dir, "orders")
    money = F.concat(F.lit("$"), F.format_number(F.col("o_totalprice"), 2))
    return o.select(
        F.col("o_orderkey").cast("string").alias("listing_id"),
        F.col("o_custkey").alias("host_id"),
        X.parse_price(money).alias("price"),
        (F.col("o_orderkey") % 5).cast("int").alias("bedrooms"),
        F.to_date(F.col("o_orderdate")).alias("first_review"),
    )


_LINEITEM_REVIEW_EXPRS = [
    "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS review_id",
    "CAST(l_partkey AS STRING) AS listing_id",
    "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + dayofmonth(l_shipdate) AS INT) AS date_key",
    "CAST(NULL AS INT) AS rating",
    "CAST(NULL AS STRING) AS comments",
    "CAST(NULL AS INT) AS tokens_ct",
    "CASE WHEN l_returnflag = 'N' THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment_label",
    "CAST(CAST(round(l_discount * 100) AS INT) AS DOUBLE) / 16.0D AS sentiment_score",
    "to_date(l_shipdate) AS review_date",
]


def reviews_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fact_reviews``-shaped stand-in: one review per line item.

    review_id = 'orderkey-linenumber' (not unique: feeds the duplicate gate);
    listing = part; date = ship date; label POSITIVE when l_returnflag = 'N';
    score = round(l_discount * 100) / 16 (exact sixteenths).
    """
    return read_table(spark, sf_dir, "lineitem").selectExpr(*_LINEITEM_REVIEW_EXPRS)


def reviews_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as reviews of the order-listings (listing_id = l_orderkey)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
         .alias("review_id"),
        F.col("l_orderkey").cast("string").alias("listing_id"),
    )


def text_reviews(spark: SparkSession, sf_dir: str, listing_col: str = "doc_id") -> DataFrame:
    """Documents as review text: review_id = doc_id, comments = text.

    ``listing_col`` picks what a document is a review *of*: itself (``doc_id``)
    or its ``source`` (20 sources, many reviews each).
    """
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col(listing_col).cast("string").alias("listing_id"),
        F.col("text").alias("comments"),
        F.col("lang"),
    )


def text_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as listings (listing_id = doc_id)."""
    lb = read_table(spark, sf_dir, "labels")
    return lb.select(F.col("doc_id").cast("string").alias("listing_id"),
                     F.col("quality"), F.col("toxic"))
