"""Kept views equal a full recomputation, also after a replaced day, and an update reads one day."""

import glob
import os

from pyspark.sql import functions as F

from lodgelens.operators import analysis as AN
from lodgelens.operators import curate as C
from lodgelens.operators import rollups as RU
from lodgelens.sources import curated as CU
from lodgelens.sources import standins as S

DAYS = ["2024-09-01", "2024-09-02", "2024-09-03"]


def _facts(spark, sf):
    f = S.reviews_from_lineitem(spark, sf)
    return f, F.pmod(F.xxhash64("review_id"), F.lit(3)).cast("int")


def _stage(spark, sf, root, days=DAYS):
    fact, place = _facts(spark, sf)
    listing = S.listings_from_part(spark, sf, with_city=True)
    date = C.build_dim_date(fact, "review_date")
    for i, ds in enumerate(DAYS):
        if ds in days:
            CU.write_partition(fact.where(place == i).drop("review_date"), f"{root}/fact_reviews", ds)
            CU.write_partition(listing, f"{root}/dim_listing", ds)
            CU.write_partition(date, f"{root}/dim_date", ds)


def _same(a, b):
    key = lambda r: tuple(map(str, r[:4]))
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_views_equal_recomputation_after_a_replaced_day(spark, sf_small, tmp_root):
    _stage(spark, sf_small, tmp_root)
    wrong = CU.scan_curated_partition(spark, f"{tmp_root}/fact_reviews", DAYS[0]).drop("ds").withColumn("sentiment_label", F.lit("NEGATIVE"))
    CU.write_partition(wrong.limit(100), f"{tmp_root}/fact_reviews", DAYS[1])
    for ds in DAYS:
        RU.update_day(spark, tmp_root, ds)
    _stage(spark, sf_small, tmp_root, [DAYS[1]])
    # an update of the replaced day can't read the others: their files are no Parquet
    for ds in (DAYS[0], DAYS[2]):
        for table in ("fact_reviews", "dim_listing", "dim_date"):
            for file in glob.glob(f"{tmp_root}/{table}/ds={ds}/part-*"):
                open(file, "wb").write(b"unreadable")
    RU.update_day(spark, tmp_root, DAYS[1])
    fact, place = _facts(spark, sf_small)
    listing, date = S.listings_from_part(spark, sf_small, with_city=True), C.build_dim_date(fact, "review_date")
    _same(RU.listing_sentiment(spark, tmp_root), AN.vw_listing_sentiment(fact))
    _same(RU.city_sentiment_daily(spark, tmp_root), AN.vw_city_sentiment_daily(fact, listing, date))
    two = fact.where(place < 2)
    _same(RU.listing_sentiment(spark, tmp_root, last=DAYS[1]), AN.vw_listing_sentiment(two))
    _same(RU.city_sentiment_daily(spark, tmp_root, DAYS[1], DAYS[1]), AN.vw_city_sentiment_daily(fact.where(place == 1), listing, date))


def test_a_range_prunes_days(spark, sf_small, tmp_root):
    _stage(spark, sf_small, tmp_root)
    for ds in DAYS:
        RU.update_day(spark, tmp_root, ds)
    read = RU.listing_sentiment(spark, tmp_root, DAYS[2])
    assert "PartitionFilters: [isnotnull(ds" in read._jdf.queryExecution().executedPlan().toString()


def test_host_sketches_merge(spark, tmp_root):
    ranges = {"2024-09-01": (0, 60_000), "2024-09-02": (40_000, 100_000), "2024-09-03": (0, 0)}
    for ds, (a, b) in ranges.items():
        CU.write_partition(RU.host_rollup(spark.range(a, b).union(spark.range(a, b)).select(F.col("id").alias("host_id"))), f"{tmp_root}/rollup_hosts", ds)
    near = lambda n, exact: abs(n - exact) <= 0.04 * exact  # noqa: E731  five standard errors
    assert near(RU.distinct_hosts(spark, tmp_root).first().n_hosts, 100_000)
    assert near(RU.distinct_hosts(spark, tmp_root, last="2024-09-01").first().n_hosts, 60_000)
    assert RU.distinct_hosts(spark, tmp_root, first="2024-09-03").first().n_hosts == 0
    assert {r.hosts for r in spark.read.parquet(f"{tmp_root}/rollup_hosts").collect()} == {60_000, 0}


def test_an_empty_day_has_empty_partials(spark, sf_small, tmp_root):
    _stage(spark, sf_small, tmp_root, DAYS[:1])
    none = CU.scan_curated_partition(spark, f"{tmp_root}/fact_reviews", DAYS[0]).drop("ds").limit(0)
    CU.write_partition(none, f"{tmp_root}/fact_reviews", DAYS[0])
    RU.update_day(spark, tmp_root, DAYS[0])
    assert RU.listing_sentiment(spark, tmp_root).count() == 0 and RU.city_sentiment_daily(spark, tmp_root).count() == 0
    assert os.path.isdir(f"{tmp_root}/rollup_listing/ds={DAYS[0]}")
