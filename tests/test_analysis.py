"""Analyses on small hand-built tables (ties, NULL groups, thresholds)."""


from lodgelens.operators import analysis as AN


def _listings(spark, rows):
    return spark.createDataFrame(rows, "listing_id string, property_type string, price double, "
                                       "neighbourhood_cleansed string, availability_30 int")


def test_price_landscape_exact_percentiles(spark):
    rows = [(str(i), "flat", float(i), "n", 1) for i in range(10)] + [("x", "flat", None, "n", 1)]
    out = AN.price_landscape(_listings(spark, rows)).first()
    assert (out.listings, out.avg_price, out.median_price, out.p90_price) == (10, 4.5, 4.5, 8.1)


def test_price_landscape_approximate(spark):
    rows = [(str(i), "flat", float(i), "n", 1) for i in range(101)]
    out = AN.price_landscape(_listings(spark, rows), approximate=True).first()
    assert out.median_price == 50.0 and 89.0 <= out.p90_price <= 91.0


def test_top_neighbourhoods_ties_break_on_name(spark):
    rows = [("1", "t", 1.0, "b", 1), ("2", "t", 1.0, "a", 1), ("3", "t", 1.0, "c", 1), ("4", "t", 1.0, "c", 1)]
    got = [tuple(r) for r in AN.top_neighbourhoods(_listings(spark, rows), 2).collect()]
    assert got == [("c", 2), ("a", 1)]


def test_best_worst_threshold_and_bands(spark):
    rows = []
    for lid, n, pos in [("a", 20, 20), ("b", 25, 5), ("c", 19, 19), ("d", 30, 15)]:
        rows += [(f"{lid}{i}", lid, "POSITIVE" if i < pos else "NEGATIVE", 0.5) for i in range(n)]
    fact = spark.createDataFrame(rows, "review_id string, listing_id string, sentiment_label string, "
                                       "sentiment_score double")
    out = {(r.band, r.listing_id): r.positive_rate for r in AN.best_worst_listings(fact, 20, 2).collect()}
    assert out == {("TOP", "a"): 1.0, ("TOP", "d"): 0.5, ("BOTTOM", "b"): 0.2, ("BOTTOM", "d"): 0.5}


def test_superhost_null_is_a_group(spark):
    df = spark.createDataFrame([(True, 10.0, 4.0), (None, 20.0, 5.0), (None, 30.0, None)],
                               "host_is_superhost boolean, price double, review_scores_rating double")
    out = {r.host_is_superhost: (r.listings, r.avg_price, r.avg_rating)
           for r in AN.superhost_compare(df).collect()}
    assert out == {True: (1, 10.0, 4.0), None: (2, 25.0, 5.0)}


def test_kpi_attach_keeps_unreviewed_listings(spark):
    dim = spark.createDataFrame([("a", "x", 1.0, 4.0), ("b", "y", 2.0, 5.0)],
                                "listing_id string, city string, price double, review_scores_rating double")
    fact = spark.createDataFrame([("r1", "a", "POSITIVE", 0.25)],
                                 "review_id string, listing_id string, sentiment_label string, sentiment_score double")
    out = [tuple(r) for r in AN.listing_kpi_attach(dim, fact).collect()]
    assert out == [("a", "x", 1.0, 4.0, 1, 1.0, 0.25), ("b", "y", 2.0, 5.0, None, None, None)]
