"""A listing holding a third of all reviews: results stay whole and exact,
aggregations reduce the hot key map-side, and AQE splits the hot partition
of a row-level join."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from lodgelens.operators import adhoc as A
from lodgelens.operators import analysis as AN
from lodgelens.operators import curate as C


def _skewed_reviews(spark, n=30000):
    # listing 'hot' gets every third review; the rest spread over 1,000 listings
    return spark.range(n).select(
        F.col("id").cast("string").alias("review_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise((F.col("id") % 1000).cast("string")).alias("listing_id"),
        F.when(F.col("id") % 2 == 0, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE")).alias("sentiment_label"),
        ((F.col("id") % 4).cast("double") * 0.25).alias("sentiment_score"),
        F.lit("x" * 50).alias("comments"),
    ).repartition(8)


def _listings(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("listing_id"))
    return ids.unionByName(spark.range(1).select(F.lit("hot").alias("listing_id"))) \
              .withColumn("city", F.lit("c"))


@contextmanager
def _conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_listing_aggregates_exactly(spark):
    fact = _skewed_reviews(spark)
    out = {r.listing_id: r for r in AN.vw_listing_sentiment(fact).collect()}
    assert out["hot"].reviews == 10000 and out["hot"].positive_rate == 0.5
    assert sum(r.reviews for r in out.values()) == 30000


def test_hot_key_dedupe(spark):
    df = spark.range(30000).select(F.lit("k").alias("key"), F.col("id").alias("seq")).repartition(8)
    out = C.dedupe_by_key(df, "key", order_by=[F.col("seq")]).collect()
    assert [(r.key, r.seq) for r in out] == [("k", 29999)]


def test_aqe_splits_hot_partition_of_row_level_join(spark):
    fact = _skewed_reviews(spark)
    with _conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }):
        joined = A.join_listing_reviews(_listings(spark), fact).select("listing_id", "review_id")
        rows = joined.collect()  # run this DataFrame's own plan, then read its final AQE plan
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30000 and sum(r.listing_id == "hot" for r in rows) == 10000
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan


def test_salted_join_equals_plain_join_and_spreads_hot_key(spark):
    from lodgelens.operators.joins import hot_keys, salted_join
    fact = _skewed_reviews(spark).select("review_id", "listing_id")
    listings = _listings(spark)
    assert [r.listing_id for r in hot_keys(fact, "listing_id", 100).collect()] == ["hot"]
    for how in ("inner", "left", "left_semi"):
        plain = sorted(tuple(r) for r in fact.join(listings, "listing_id", how).collect())
        salted_df = salted_join(fact, listings, "listing_id", how, buckets=8, max_hot_keys=100)
        salted = sorted(tuple(r) for r in salted_df.select(*fact.join(listings, "listing_id", how).columns).collect())
        assert salted == plain, how
        plan = salted_df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # the hot listing's rows now carry 8 different salts
    from pyspark.sql import functions as F2
    salts = (fact.where(F2.col("listing_id") == "hot")
             .select(F2.pmod(F2.xxhash64("review_id", "listing_id"), F2.lit(8)).alias("s")).distinct().count())
    assert salts == 8


def test_adhoc_joins_with_salt_match(spark):
    fact = _skewed_reviews(spark)
    listings = _listings(spark)
    a = sorted(tuple(r) for r in A.join_listing_reviews(listings, fact).collect())
    b = sorted(tuple(r) for r in A.join_listing_reviews(listings, fact, salt_buckets=8).collect())
    assert a == b and len(a) == 30000
    c = A.semi_join_known_listings(fact, listings, salt_buckets=8).select("review_id")
    assert c.count() == 30000
