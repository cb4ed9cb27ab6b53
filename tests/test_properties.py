"""Property tests (Hypothesis): rules hold for arbitrary inputs, checked in
one Spark job per property over a whole batch of generated examples."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgelens.functions import exprs as X
from lodgelens.operators import scoring as SC

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.text(max_size=120), st.integers(min_value=1, max_value=9)),
                min_size=1, max_size=40))
def test_reply_parser_total_and_never_throws(spark, replies):
    rows = [(i, reply, n, pos) for i, (reply, n) in enumerate(replies) for pos in range(n)]
    df = spark.createDataFrame(rows, "batch int, reply string, n int, pos int")
    out = df.select("batch", SC.parse_model_reply(F.col("reply"), F.col("n"), F.col("pos")).alias("p")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.p.sentiment_label in ("POSITIVE", "NEGATIVE")
        assert 0.0 <= r.p.sentiment_score <= 1.0
        assert r.p.parse_status in ("ok", "no_json", "count_mismatch", "bad_item", "failed")


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10 ** 9), min_size=1, max_size=50))
def test_money_strings_round_trip(spark, cents):
    rows = [(c, "${:,.2f}".format(c / 100)) for c in cents]
    df = spark.createDataFrame(rows, "cents long, raw string")
    for r in df.select("cents", X.parse_price(F.col("raw")).alias("p")).collect():
        assert r.p == float(f"{r.cents // 100}.{r.cents % 100:02d}")


@SETTINGS
@given(st.lists(st.text(alphabet=" \t\nab.,é", max_size=40), min_size=1, max_size=50))
def test_token_count_matches_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.token_count(F.col("t"))).collect()]
    assert got == [len(re.split(r"[ \t\n\x0b\f\r]+", t)) for t in texts]
