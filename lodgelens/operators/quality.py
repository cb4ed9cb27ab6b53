"""Data-quality gates over the curated tables.

Each gate is a small aggregate (partial aggregation, one shuffle of at most
one row per map task) except the duplicate-key listing, which returns every
repeated key as a distributed DataFrame.  ``quality_report`` stacks the gates
into one tidy ``(check_name, n_bad, passed)`` table so a run can stop before
publishing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelens.functions import exprs as X


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dq_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return _stack([df.agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(name).alias("table_name"), "rows")
                   for name, df in tables.items()])


def dq_null_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """NULL keys per table: ``{table: (df, key)}`` -> (check_name, n_bad)."""
    return _stack([df.agg(F.count_if(F.col(key).isNull()).alias("n_bad"))
                   .select(F.lit(f"{name}.{key}_nulls").alias("check_name"), "n_bad")
                   for name, (df, key) in tables.items()])


def dq_duplicate_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Every key seen more than once: (check_name, key, c)."""
    return _stack([df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
                   .where(F.col("c") > 1)
                   .select(F.lit(f"dup_{key}").alias("check_name"),
                           F.col(key).cast("string").alias("key"), "c")
                   for name, (df, key) in tables.items()])


def orphan_facts(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose ``key`` has no match in ``dim`` (LEFT JOIN ... IS NULL)."""
    return fact.join(dim.select(key), key, "left_anti")


def _orphan_count(fact: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    # facts are counted per key first (map-side), so the anti join sees one
    # row per key however many facts share it
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.join(dim.select(key), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_bad")) \
                  .select(F.lit(name).alias("check_name"), "n_bad")


def dq_orphans(fact: DataFrame, dim_listing: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Facts without a listing and facts without a calendar day."""
    return _stack([
        _orphan_count(fact, dim_listing, "listing_id", "fact_without_listing"),
        _orphan_count(fact, dim_date.select("date_key"), "date_key", "fact_without_calendar"),
    ])


MAX_PRICE, MAX_RATING = 10000, 5


def dq_ranges(dim_listing: DataFrame, max_price: float = MAX_PRICE, max_rating: float = MAX_RATING) -> DataFrame:
    """Prices outside 0..max_price and ratings outside 0..max_rating."""
    p, r = F.col("price"), F.col("review_scores_rating")
    return dim_listing.agg(
        X.indicator_sum((p < 0) | (p > max_price)).alias("price_out_of_range"),
        X.indicator_sum((r < 0) | (r > max_rating)).alias("rating_out_of_range"))


def _key_summary(df: DataFrame, key: str, extra: dict | None = None) -> DataFrame:
    """One grouped pass over a table: rows per key (NULL key included) plus
    any additive per-row counters, reduced map-side before the shuffle."""
    aggs = [F.count(F.lit(1)).alias("c")] + [v.alias(k) for k, v in (extra or {}).items()]
    return df.groupBy(key).agg(*aggs)


def _checks(summary: DataFrame, key: str, checks: dict) -> DataFrame:
    """Turn a key summary into (check_name, n_bad) rows, one global agg."""
    names = list(checks)
    row = summary.agg(*[checks[k].alias(f"_v{i}") for i, k in enumerate(names)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("check_name"),
                 F.coalesce(F.col(f"_v{i}"), F.lit(0)).cast("long").alias("n_bad"))
        for i, k in enumerate(names)])).alias("g")).select("g.*")


def quality_report(dim_listing: DataFrame, dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """All gates as (check_name, n_bad, passed), in few passes.

    The same checks as the ``dq_*`` functions, computed from one grouped
    pass per table: NULL keys, duplicate keys and the range counters all
    come from the per-key counts; both orphan checks come from one
    per-(listing, day) count of the facts.  The fact table is read twice,
    not once per check.
    """
    p, r = F.col("price"), F.col("review_scores_rating")
    listing = _key_summary(dim_listing, "listing_id", {
        "p_bad": F.sum(F.when((p < 0) | (p > MAX_PRICE), 1).otherwise(0)),
        "r_bad": F.sum(F.when((r < 0) | (r > MAX_RATING), 1).otherwise(0)),
    })
    reviews = _key_summary(fact, "review_id")
    dates = _key_summary(dim_date, "date_key")
    null_c = lambda k: F.sum(F.when(F.col(k).isNull(), F.col("c")))
    dup = lambda k: F.count_if(F.col("c") > 1)
    frames = [
        _checks(dates, "date_key", {"dim_date.date_key_nulls": null_c("date_key")}),
        _checks(listing, "listing_id", {"dim_listing.listing_id_nulls": null_c("listing_id"),
                                        "dup_listing_id": dup("listing_id"),
                                        "price_out_of_range": F.sum("p_bad"),
                                        "rating_out_of_range": F.sum("r_bad")}),
        _checks(reviews, "review_id", {"fact_reviews.review_id_nulls": null_c("review_id"),
                                       "dup_review_id": dup("review_id")}),
    ]
    per_key = fact.groupBy("listing_id", "date_key").agg(F.count(F.lit(1)).alias("n"))
    for name, key, dim in (("fact_without_listing", "listing_id", dim_listing),
                           ("fact_without_calendar", "date_key", dim_date)):
        orphans = per_key.join(dim.select(key), key, "left_anti")
        frames.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_bad"))
                      .select(F.lit(name).alias("check_name"), "n_bad"))
    out = _stack([f.select("check_name", F.col("n_bad").cast("long").alias("n_bad")) for f in frames])
    return out.withColumn("passed", F.col("n_bad") == 0)
