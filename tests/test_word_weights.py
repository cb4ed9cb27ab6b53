"""Learned word weights against a plain second implementation, on copies, nulls and empty tables, and in the daily job."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lodgelens.operators import word_weights as WW


def words(text):
    return {w for w in re.split("[^a-z]+", (text or "").lower()) if w}


def plain_weights(rows, min_texts=3, least=100):
    rows = [(t, y) for t, y in rows if y is not None]
    p, n = sum(y for _, y in rows), sum(not y for _, y in rows)
    pos, neg = (collections.Counter(w for t, y in rows if y == want for w in words(t)) for want in (True, False))
    out = {"": (p, n, math.floor(1000 * math.log((p + 1) / (n + 1))))}
    for w in pos.keys() | neg.keys():
        x = math.floor(1000 * math.log((pos[w] + 1) * (n + 2) / ((neg[w] + 1) * (p + 2))))
        if pos[w] + neg[w] >= min_texts and abs(x) >= least:
            out[w] = (pos[w], neg[w], x)
    return out


def reviews(rng, n):
    """(text, label) with some words that lean to a side."""
    rows = []
    for _ in range(n):
        good = rng.random() < 0.7
        picked = rng.choices(["host", "flat", "street", "stay", "two", "days"], k=6) + rng.choices(
            ["sunny", "warm", "smile"] if good else ["mould", "damp", "smile"], k=2)
        rng.shuffle(picked)
        rows.append((" ".join(picked).title() + "!", good))
    return rows


@pytest.fixture(scope="module")
def taught(spark):
    rows = reviews(random.Random(1), 400) + [(None, True), ("", False), ("no label", None), ("Grüße aus KÖLN", True)]
    return rows, WW.learn_weights(spark.createDataFrame(rows, "comments string, good boolean"), "comments", F.col("good"))


def test_weights_match_a_plain_count(taught):
    rows, weights = taught
    assert {r.token: (r.n_pos, r.n_neg, r.weight) for r in weights.collect()} == plain_weights(rows)


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_scores_match_a_plain_sum(spark, taught, broadcast):
    rows, weights = taught
    known = plain_weights(rows)
    texts = [t for t, _ in reviews(random.Random(2), 100)] + [None, "", "12", "warm warm", "unknown words"] + ["sunny stay"] * 3000
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        d = spark.createDataFrame([(i % 50, t, "old") for i, t in enumerate(texts)], "review_id int, comments string, sentiment_label string")
        got = collections.Counter((r.review_id, r.comments, r.evidence, r.sentiment_label, r.sentiment_score) for r in WW.score_texts(d, weights).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = collections.Counter()
    for i, t in enumerate(texts):
        e = known[""][2] + sum(known[w][2] for w in words(t) if w in known)
        want[i % 50, t, e, "POSITIVE" if e > 0 else "NEGATIVE", (abs(e) + 1000) / (abs(e) + 2000)] += 1
    assert got == want


def test_learned_weights_judge_unseen_reviews(spark, taught):
    _, weights = taught
    unseen = [(i, t, y) for i, (t, y) in enumerate(reviews(random.Random(3), 300)) if words(t) & {"sunny", "warm", "mould", "damp"}]
    got = WW.score_texts(spark.createDataFrame(unseen, "review_id int, comments string, good boolean"), weights).collect()
    assert all((r.sentiment_label == "POSITIVE") == r.good for r in got) and len(got) == len(unseen)


def test_empty_tables(spark, taught):
    none = spark.createDataFrame([], "review_id int, comments string, good boolean")
    weights = WW.learn_weights(none, "comments", F.col("good"))
    assert [tuple(r) for r in weights.collect()] == [("", 0, 0, 0)]
    assert WW.score_texts(none, taught[1]).count() == 0
    one = WW.score_texts(spark.createDataFrame([(1, "sunny")], "review_id int, comments string"), weights).first()
    assert (one.evidence, one.sentiment_label, one.sentiment_score) == (0, "NEGATIVE", 0.5)


def test_no_text_is_shuffled_to_score(spark, taught):
    d = spark.createDataFrame([(1, "sunny")], "review_id int, comments string")
    plan = WW.score_texts(d, taught[1]).select("review_id", "evidence")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and not re.search(r"hashpartitioning\((comments|text)", plan)
