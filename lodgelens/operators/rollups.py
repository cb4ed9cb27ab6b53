"""Views that are kept by day: mergeable partials of one day's tables, merged on read.

A day's facts are reduced once, when the day is written, to three small tables
beside the curated ones (a partition a day, so a rerun replaces that day's):

``rollup_listing``    per listing: reviews, positive ones, score sum and count
``rollup_city_day``   the same counts per calendar day and city
``rollup_hosts``      one row: an HLL sketch of the host ids and their number

Counts and sums add up over days and sketches merge, so a view over any range
of days reads the partials of those days, never a fact, and updating a day
reads that day only.  Each review belongs to the day that it was staged under.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelens.functions import exprs as X
from lodgelens.operators.analysis import listing_partials
from lodgelens.sources import curated as CU

#: log2 of a host sketch's registers: a standard error of 1.04 / sqrt(2^14), 0.8 %, in 16 KB a day at most.
SKETCH_BITS = 14

COUNTS = ["n_reviews", "n_positive", "score_sum", "score_n"]


def _merged(partials: DataFrame, *keys: str) -> DataFrame:
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])


def listing_rollup(fact: DataFrame) -> DataFrame:
    return listing_partials(fact)


def city_day_rollup(fact: DataFrame, dim_listing: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Counts per calendar day and city, of facts whose listing and day are known.

    Facts are counted by listing and day before they meet the listings, so a
    listing with a third of the facts brings a row a day to the join.
    """
    parts = listing_partials(fact, ["date_key"]).join(dim_listing.select("listing_id", "city"), "listing_id")
    days = _merged(parts, "date_key", "city").join(dim_date.select("date_key", "yyyy", "mm", "dd"), "date_key")
    return days.select("yyyy", "mm", "dd", "city", *COUNTS)


def host_rollup(dim_listing: DataFrame) -> DataFrame:
    """One row: a mergeable sketch of the distinct host ids, and their exact number that day.

    Distinct ids are found first (map-side), so both come from one pass.
    """
    return (dim_listing.select(F.col("host_id").cast("long").alias("host_id")).distinct()
            .agg(F.hll_sketch_agg("host_id", SKETCH_BITS).alias("sketch"), F.count("host_id").alias("hosts")))


def update_day(spark: SparkSession, curated_root: str, ds) -> dict[str, str]:
    """Make the partials of one day anew from its curated tables; reads that day's partitions alone."""
    base = curated_root.rstrip("/")
    fact, listing, date = (CU.load_snapshot(spark, f"{base}/{t}", t, ds) for t in ("fact_reviews", "dim_listing", "dim_date"))
    made = {"rollup_listing": listing_rollup(fact), "rollup_city_day": city_day_rollup(fact, listing, date),
            "rollup_hosts": host_rollup(listing)}
    return {name: CU.write_partition(df, f"{base}/{name}", ds) for name, df in made.items()}


def _days(spark: SparkSession, curated_root: str, name: str, first=None, last=None) -> DataFrame:
    """The partials of the days from ``first`` to ``last`` (both included, None: open); other days aren't read."""
    df = CU.read_table_root(spark, f"{curated_root.rstrip('/')}/{name}")
    for bound, keep in ((first, F.col("ds") >= F.lit(str(first)).cast("date")), (last, F.col("ds") <= F.lit(str(last)).cast("date"))):
        df = df.where(keep) if bound is not None else df
    return df


def listing_sentiment(spark: SparkSession, curated_root: str, first=None, last=None) -> DataFrame:
    """``vw_listing_sentiment`` over the staged days asked for."""
    p = _merged(_days(spark, curated_root, "rollup_listing", first, last), "listing_id")
    return p.select("listing_id", F.col("n_reviews").alias("reviews"), X.safe_ratio(F.col("n_positive"), F.col("n_reviews")).alias("positive_rate"),
                    X.safe_ratio(F.col("score_sum"), F.col("score_n")).alias("avg_conf"))


def city_sentiment_daily(spark: SparkSession, curated_root: str, first=None, last=None) -> DataFrame:
    """``vw_city_sentiment_daily`` over the staged days asked for."""
    p = _merged(_days(spark, curated_root, "rollup_city_day", first, last), "yyyy", "mm", "dd", "city")
    return p.select("yyyy", "mm", "dd", "city", F.col("n_reviews").alias("reviews"),
                    X.safe_ratio(F.col("n_positive"), F.col("n_reviews")).alias("positive_rate"))


def distinct_hosts(spark: SparkSession, curated_root: str, first=None, last=None) -> DataFrame:
    """About how many hosts had a listing on any of the days: one row, n_hosts (0 without days)."""
    days = _days(spark, curated_root, "rollup_hosts", first, last)
    return days.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_hosts"))
