"""Golden end-to-end run: hand-written raw CSVs -> curated -> scored -> gates
-> warehouse -> analyses, plus backfill."""

import datetime as dt
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lodgelens.operators import analysis as AN
from lodgelens.plans import daily as P
from lodgelens.operators import rollups as RU
from lodgelens.sources import curated as CU
from lodgelens.sources import warehouse as W

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTINGS = """ID,Host_ID,property_type,room_type,accommodates,price,bathrooms,bathrooms_text,bedrooms,beds,neighbourhood_cleansed,latitude,longitude,minimum_nights,maximum_nights,availability_30,number_of_reviews,review_scores_rating,host_is_superhost,host_response_rate,host_acceptance_rate,instant_bookable,amenities,has_availability
1,10,Apartment,Entire home,4,"$1,250.00",,1.5 baths,2,2,Camden,51.5,-0.1,2,30,10,40,4.9,t,97%,N/A,t,"[""Wifi"", ""TV""]",t
2,10,Apartment,Private room,2,$80.00,1,1 bath,1,1,Camden,51.5,-0.1,1,10,5,12,4.5,f,100%,90%,f,"Wifi, Kitchen ,Iron",t
3,11,House,Entire home,6,$45.00,2,2 baths,3,4,Hackney,51.6,-0.05,3,60,0,0,,,,,t,[],f
3,11,House,Entire home,6,$45.00,2,2 baths,3,4,Hackney,51.6,-0.05,3,60,0,0,,,,,t,[],f
"""

REVIEWS = """id,listing_id,date,comments
100,1,2024-09-01,"Great place, very clean.
Would come back!"
101,1,2024-09-01,"Dirty and noisy, the ""view"" was bad"
102,2,2024-8-31,lovely host
103,2,not a date,dropped for its date
104,99,2024-09-01,no such listing
105,3,2024-09-01,
"""


def _land(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture()
def raw_day(tmp_root):
    raw = os.path.join(tmp_root, "raw")
    _land(raw, "listings", LISTINGS)
    _land(raw, "reviews", REVIEWS)
    return raw


def test_golden_run_day(spark, tmp_root, raw_day):
    cur, wh = os.path.join(tmp_root, "curated"), os.path.join(tmp_root, "wh")
    res = P.run_day(spark, raw_day, cur, wh, "2024-09-01", loaded_at=dt.datetime(2024, 9, 1, 6))
    assert res["ds"] == dt.date(2024, 9, 1)
    assert all(g["passed"] for g in res["gates"]), res["gates"]

    dim = {r.listing_id: r for r in W.read(spark, wh)["dim_listing"].collect()}
    assert sorted(dim) == ["1", "2", "3"]
    one = dim["1"]
    assert (one.price, one.price_bucket, one.bathrooms, one.host_is_superhost) == (1250.0, "gte_400", 1.5, True)
    assert (one.host_response_rate, one.host_acceptance_rate, one.amenities_count) == (97.0, None, 2)
    assert (one.city, one.country, one.capacity) == ("London", "UK", 4)
    assert dim["2"].amenities_count == 3 and dim["2"].price_bucket == "50_99"
    assert dim["3"].host_is_superhost is None and dim["3"].review_scores_rating is None

    cal = sorted(r.date_key for r in W.read(spark, wh)["dim_date"].collect())
    assert cal == [20240831, 20240901]  # 104's day is kept: the calendar precedes the semi join

    stage = {r.review_id: r for r in CU.scan_curated_partition(
        spark, f"{cur}/fact_reviews_stage", "2024-09-01").collect()}
    assert sorted(stage) == ["100", "101", "102", "105"]
    assert stage["100"].comments == "Great place, very clean.\nWould come back!"
    assert stage["100"].tokens_ct == 7 and stage["105"].comments is None and stage["105"].tokens_ct == 1

    facts = {r.review_id: r for r in W.read(spark, wh)["fact_reviews"].collect()}
    assert sorted(facts) == ["100", "101", "102"]  # 105 has no text to score
    assert facts["100"].sentiment_label == "POSITIVE" and facts["101"].sentiment_label == "NEGATIVE"
    assert res["scored_rows"] == 3

    wl = W.read(spark, wh)["dim_listing"]
    wf = W.read(spark, wh)["fact_reviews"]
    wd = W.read(spark, wh)["dim_date"]
    months = [tuple(r) for r in AN.reviews_by_month(wf, wd).collect()]
    assert months == [(2024, 8, 1), (2024, 9, 2)]
    split = {r.sentiment_label: r.reviews for r in AN.sentiment_split(wf).collect()}
    assert split == {"POSITIVE": 2, "NEGATIVE": 1}


def test_rerun_is_idempotent_and_backfill_keeps_days(spark, tmp_root, raw_day):
    cur, wh = os.path.join(tmp_root, "curated"), os.path.join(tmp_root, "wh")
    P.backfill(spark, [(raw_day, "2024-09-01"), (raw_day, "2024-09-02")], cur, wh)
    P.run_day(spark, raw_day, cur, wh, "2024-09-01")
    days = sorted(str(r.ds) for r in spark.read.parquet(f"{cur}/dim_listing").select("ds").distinct().collect())
    assert days == ["2024-09-01", "2024-09-02"]
    assert spark.read.parquet(f"{cur}/dim_listing").where(F.col("ds") == "2024-09-01").count() == 3


def test_score_day_falls_back_to_latest(spark, tmp_root, raw_day):
    cur = os.path.join(tmp_root, "curated")
    P.curate_day(spark, raw_day, cur, "2024-09-01")
    day, n = P.score_day(spark, cur, "2030-01-01")
    assert day == dt.date(2024, 9, 1) and n == 3


def test_gates_stop_the_run(spark, tmp_root, raw_day):
    bad = LISTINGS.replace('"$1,250.00"', '"$12,500.00"')
    _land(os.path.join(tmp_root, "raw2"), "listings", bad)
    _land(os.path.join(tmp_root, "raw2"), "reviews", REVIEWS)
    with pytest.raises(P.GateFailure) as e:
        P.run_day(spark, os.path.join(tmp_root, "raw2"), os.path.join(tmp_root, "c"),
                  os.path.join(tmp_root, "w"), "2024-09-01")
    assert [f["check_name"] for f in e.value.failed] == ["price_out_of_range"]


def test_run_day_with_model_scorer(spark, tmp_root, raw_day):
    def model(texts):
        return "Sure! " + json.dumps({"results": [
            {"label": "positive" if "lovely" in t else "NEGATIVE", "confidence": 0.8} for t in texts]})
    cur, wh = os.path.join(tmp_root, "curated"), os.path.join(tmp_root, "wh")
    P.run_day(spark, raw_day, cur, wh, "2024-09-01", scorer=model,
              knobs=P.ScoringKnobs(base_sleep=0.0))
    got = {r.review_id: (r.sentiment_label, r.sentiment_score, r.parse_status)
           for r in spark.read.parquet(f"{cur}/fact_reviews").collect()}
    assert got["102"] == ("POSITIVE", 0.8, "ok") and got["100"] == ("NEGATIVE", 0.8, "ok")


def test_score_day_with_nothing_to_score(spark, tmp_root):
    blank = "id,listing_id,date,comments\n200,1,2024-09-01,\n"
    raw = os.path.join(tmp_root, "raw-blank")
    _land(raw, "listings", LISTINGS)
    _land(raw, "reviews", blank)
    cur = os.path.join(tmp_root, "curated")
    P.curate_day(spark, raw, cur, "2024-09-01")
    assert P.score_day(spark, cur, "2024-09-01") == (dt.date(2024, 9, 1), 0)


def test_curate_day_observes_raw_rows(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw-messy")
    _land(raw, "listings", LISTINGS)
    _land(raw, "reviews", REVIEWS + "106,1\n107,1,2024-09-01,ok,extra,fields\n")
    out = P.curate_day(spark, raw, os.path.join(tmp_root, "curated"), "2024-09-01")
    assert out["raw"] == {"listings_rows": 4, "listings_malformed": 0,
                          "reviews_rows": 8, "reviews_malformed": 2}


def test_an_empty_day_is_published_as_that_day(spark, tmp_root, raw_day):
    cur, wh = os.path.join(tmp_root, "curated"), os.path.join(tmp_root, "wh")
    P.run_day(spark, raw_day, cur, wh, "2024-09-01")
    raw = os.path.join(tmp_root, "raw-none")
    _land(raw, "listings", LISTINGS)
    _land(raw, "reviews", "id,listing_id,date,comments\n900,77777,2024-09-02,of no known listing\n")
    out = P.run_day(spark, raw, cur, wh, "2024-09-02")
    assert out["ds"] == dt.date(2024, 9, 2) and out["scored_rows"] == 0 and out["rows"]["fact_reviews"] == 0
    assert spark.read.parquet(out["published"]["fact_reviews"]).count() == 0
    again = P.run_day(spark, raw, cur, wh, "2024-09-01")  # day 1 loses its reviews on a rerun
    assert again["scored_rows"] == 0 and CU.scan_curated_partition(spark, f"{cur}/fact_reviews", "2024-09-01").count() == 0


def test_every_staged_review_is_scored_by_default():
    assert P.ScoringKnobs().max_rows == 0


def test_a_wrong_type_is_refused(spark, tmp_root):
    root = os.path.join(tmp_root, "dim_date")
    CU.write_partition(spark.createDataFrame([("x", 1)], "date_key string, yyyy int"), root, "2024-09-01")
    with pytest.raises(TypeError):
        CU.load_snapshot(spark, root, "dim_date", "2024-09-01")


def test_place_is_a_parameter(spark, tmp_root, raw_day):
    from lodgelens.operators.curate import Place
    cur = os.path.join(tmp_root, "curated")
    P.curate_day(spark, raw_day, cur, "2024-09-01", place=Place("Ghent", "East Flanders", "Belgium"))
    assert {r.city for r in spark.read.parquet(f"{cur}/dim_listing").collect()} == {"Ghent"}


def test_a_failed_day_leaves_the_published_one(spark, tmp_root, raw_day):
    """Gates stop day 2: readers keep day 1 of all three tables, and the kept views don't see day 2."""
    cur, wh = os.path.join(tmp_root, "curated"), os.path.join(tmp_root, "wh")
    P.run_day(spark, raw_day, cur, wh, "2024-09-01")
    raw = os.path.join(tmp_root, "raw-bad")
    _land(raw, "listings", LISTINGS.replace('"$1,250.00"', '"$12,500.00"'))
    _land(raw, "reviews", REVIEWS)
    with pytest.raises(P.GateFailure):
        P.run_day(spark, raw, cur, wh, "2024-09-02")
    v = W.resolve(spark, wh)
    assert (v.number, v.ds, v.rows) == (1, "2024-09-01", {"dim_listing": 3, "dim_date": 2, "fact_reviews": 3})
    assert {r.listing_id: r.reviews for r in RU.listing_sentiment(spark, cur).collect()} == {"1": 2, "2": 1}


def test_kept_views_follow_replaced_days(spark, tmp_root, raw_day):
    cur, wh = os.path.join(tmp_root, "curated"), os.path.join(tmp_root, "wh")
    P.backfill(spark, [(raw_day, "2024-09-01"), (raw_day, "2024-09-02")], cur, wh)
    assert {r.listing_id: r.reviews for r in RU.listing_sentiment(spark, cur).collect()} == {"1": 4, "2": 2}
    raw = os.path.join(tmp_root, "raw-2")
    _land(raw, "listings", LISTINGS)
    _land(raw, "reviews", "id,listing_id,date,comments\n900,1,2024-09-02,great stay\n")
    P.run_day(spark, raw, cur, wh, "2024-09-02")
    got = {r.listing_id: (r.reviews, r.positive_rate) for r in RU.listing_sentiment(spark, cur).collect()}
    assert got == {"1": (3, 2 / 3), "2": (1, 1.0)}
    days = sorted((r.yyyy, r.mm, r.dd, r.city, r.reviews) for r in RU.city_sentiment_daily(spark, cur).collect())
    assert days == [(2024, 8, 31, "London", 1), (2024, 9, 1, "London", 2), (2024, 9, 2, "London", 1)]
    assert [r.reviews for r in RU.listing_sentiment(spark, cur, first="2024-09-02").collect()] == [1]
    assert RU.distinct_hosts(spark, cur).first().n_hosts == 2
    assert RU.distinct_hosts(spark, cur, last="2024-08-01").first().n_hosts == 0


def test_a_rerun_with_a_ledger_asks_nothing(spark, tmp_root, raw_day):
    cur = os.path.join(tmp_root, "curated")
    P.curate_day(spark, raw_day, cur, "2024-09-01")
    knobs = P.ScoringKnobs(base_sleep=0.0, max_retries=1, ledger=os.path.join(tmp_root, "ledger"), waves=2)
    P.score_day(spark, cur, "2024-09-01", lambda texts: json.dumps({"results": [{"label": "POSITIVE", "confidence": 0.9}] * len(texts)}), knobs)

    def unreachable(texts):
        raise RuntimeError("asked again")
    assert P.score_day(spark, cur, "2024-09-01", unreachable, knobs)[1] == 3
    got = {(r.sentiment_label, r.sentiment_score, r.parse_status) for r in CU.scan_curated_partition(spark, f"{cur}/fact_reviews", "2024-09-01").collect()}
    assert got == {("POSITIVE", 0.9, "ok")}


def test_a_day_scored_by_learned_weights(spark, tmp_root, raw_day):
    from pyspark.sql import functions as F

    from lodgelens.operators import word_weights as WW
    cur, at = os.path.join(tmp_root, "curated"), os.path.join(tmp_root, "weights")
    taught = spark.createDataFrame([("lovely stay", True), ("great host", True), ("awful noise", False), ("dirty", False)], "text string, good boolean")
    WW.learn_weights(taught, "text", F.col("good"), min_texts=1).write.parquet(at)
    P.curate_day(spark, raw_day, cur, "2024-09-01")
    assert P.score_day(spark, cur, "2024-09-01", knobs=P.ScoringKnobs(weights=at))[1] == 3
    facts = CU.scan_curated_partition(spark, f"{cur}/fact_reviews", "2024-09-01").collect()
    assert all(r.parse_status == "ok" and 0.5 <= r.sentiment_score < 1 for r in facts)
