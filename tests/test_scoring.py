"""Reply parser rules, the batch runner and the lexicon scorer."""

import json
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lodgelens.operators import scoring as SC

# test-local scorers run in Python workers, which cannot import this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _parse(spark, reply, n):
    rows = [(reply, n, i) for i in range(n)]
    df = spark.createDataFrame(rows, "reply string, n int, pos int")
    out = df.select("pos", SC.parse_model_reply(F.col("reply"), F.col("n"), F.col("pos")).alias("p"))
    return [(r["p"]["sentiment_label"], r["p"]["sentiment_score"], r["p"]["parse_status"])
            for r in out.orderBy("pos").collect()]


def test_reply_inside_text(spark):
    reply = 'Here:\n{"results":[{"label":"POSITIVE","confidence":0.9},{"label":"NEGATIVE","confidence":0.2}]}\nbye'
    assert _parse(spark, reply, 2) == [("POSITIVE", 0.9, "ok"), ("NEGATIVE", 0.2, "ok")]


def test_lower_case_and_unknown_label(spark):
    reply = '{"results":[{"label":"positive","confidence":0.7},{"label":"MIXED","confidence":0.6}]}'
    assert _parse(spark, reply, 2) == [("POSITIVE", 0.7, "ok"), ("NEGATIVE", 0.6, "ok")]


def test_no_json_and_count_mismatch(spark):
    assert _parse(spark, "no json", 2) == [("NEGATIVE", 0.0, "no_json")] * 2
    one = '{"results":[{"label":"POSITIVE","confidence":0.9}]}'
    assert _parse(spark, one, 2) == [("NEGATIVE", 0.0, "count_mismatch")] * 2
    assert _parse(spark, None, 2) == [("NEGATIVE", 0.0, "failed")] * 2


def test_confidence_clamped_and_bad(spark):
    reply = '{"results":[{"label":"POSITIVE","confidence":2},{"label":"POSITIVE","confidence":"high"},' \
            '{"label":"POSITIVE"},{"label":"POSITIVE","confidence":-1}]}'
    assert _parse(spark, reply, 4) == [("POSITIVE", 1.0, "ok"), ("NEGATIVE", 0.0, "bad_item"),
                                       ("POSITIVE", 0.0, "ok"), ("POSITIVE", 0.0, "ok")]


def test_null_item_and_results_null(spark):
    reply = '{"results":[null,{"label":"POSITIVE","confidence":0.5}]}'
    assert _parse(spark, reply, 2) == [("NEGATIVE", 0.0, "bad_item"), ("POSITIVE", 0.5, "ok")]
    assert _parse(spark, '{"results": null}', 1) == [("NEGATIVE", 0.0, "no_json")]


def test_build_prompt_holds_whole_texts():
    p = SC.build_prompt(["a" * 1200, None])
    assert json.loads(p.split("\n", 1)[1]) == [{"review": 1, "text": "a" * 1200}, {"review": 2, "text": ""}]
    assert "a" * 11 not in SC.build_prompt(["a" * 1200], max_chars=10)


def test_building_a_plan_runs_no_job(spark):
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    try:
        df = spark.range(1000).selectExpr("cast(id % 7 as string) k", "'x' comments").groupBy("k").agg(F.max("comments").alias("comments"))
        SC.lexicon_score(df)
        SC.score_batches(df, SC.LexiconReplyScorer(), max_concurrency=2)
        assert not seen.getJobIdsForGroup("plan")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


class _Echo:
    """Scores by text: 'good' -> POSITIVE 0.75; remembers nothing across calls."""

    def __call__(self, texts):
        return json.dumps({"results": [
            {"label": "POSITIVE" if "good" in t else "NEGATIVE", "confidence": 0.75} for t in texts]})


def test_score_batches_keeps_rows_keyed(spark):
    rows = [(str(i), "good stay" if i % 3 == 0 else "meh") for i in range(50)]
    df = spark.createDataFrame(rows, "review_id string, comments string").repartition(5)
    out = SC.score_batches(df, _Echo(), base_sleep=0.0)
    got = {r["review_id"]: (r["sentiment_label"], r["parse_status"]) for r in out.collect()}
    assert len(got) == 50
    for i in range(50):
        assert got[str(i)] == ("POSITIVE" if i % 3 == 0 else "NEGATIVE", "ok")


class _Flaky:
    def __init__(self, fail_times):
        self.fail_times = fail_times
        self.calls = 0

    def __call__(self, texts):
        self.calls += 1
        if self.calls <= self.fail_times:
            raise RuntimeError("rate limited")
        return _Echo()(texts)


def test_retries_then_success(spark):
    df = spark.createDataFrame([("1", "good")], "review_id string, comments string").coalesce(1)
    out = SC.score_batches(df, _Flaky(2), base_sleep=0.0).collect()
    assert (out[0]["sentiment_label"], out[0]["parse_status"]) == ("POSITIVE", "ok")


def test_failure_defaults_after_retries(spark):
    df = spark.createDataFrame([("1", "good"), ("2", "bad")], "review_id string, comments string").coalesce(1)
    out = SC.score_batches(df, _Flaky(100), base_sleep=0.0).collect()
    assert {(r["sentiment_label"], r["sentiment_score"], r["parse_status"]) for r in out} == \
        {("NEGATIVE", 0.0, "failed")}


def test_wrong_count_defaults_whole_batch(spark):
    def short(texts):
        return json.dumps({"results": [{"label": "POSITIVE", "confidence": 1}]})
    df = spark.createDataFrame([(str(i), "x") for i in range(3)], "review_id string, comments string").coalesce(1)
    out = SC.score_batches(df, short, base_sleep=0.0, parallelism=1).collect()
    assert {r["parse_status"] for r in out} == {"count_mismatch"}


def test_batches_never_exceed_size(spark):
    seen = []

    def spy(texts):
        assert 1 <= len(texts) <= 8
        return _Echo()(texts)
    df = spark.createDataFrame([(str(i), "x") for i in range(21)], "review_id string, comments string").coalesce(1)
    assert SC.score_batches(df, spy, base_sleep=0.0).count() == 21


def test_lexicon_column_matches_python_scorer(spark):
    texts = ["Great place, very clean and quiet!", "Dirty, noisy and rude host.", "", None,
             "good bad", "The BEST. best? Best!"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "review_id string, comments string")
    col = {r["review_id"]: (r["sentiment_label"], r["sentiment_score"])
           for r in SC.lexicon_score(df).collect()}
    via_runner = {r["review_id"]: (r["sentiment_label"], r["sentiment_score"])
                  for r in SC.score_batches(df, SC.LexiconReplyScorer(), base_sleep=0.0).collect()}
    assert col == via_runner
    assert col["0"][0] == "POSITIVE" and col["1"][0] == "NEGATIVE"
    assert col["4"] == ("NEGATIVE", 0.5) and col["5"] == ("POSITIVE", 0.8)


def test_spread_deals_to_the_asked_partitions(spark):
    one = spark.range(100).coalesce(1)
    assert SC.spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert SC.spread(many, 4).rdd.getNumPartitions() == 4


def test_lexicon_udf_matches_columns(spark):
    texts = ["Great place, very clean and quiet!", "Dirty, noisy and rude host.", "", None, "GOOD-good;good"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "review_id string, comments string")
    pos, neg = SC.lexicon_counts(F.col("comments"))
    got = df.select("review_id", SC.lexicon_hits(F.col("comments")).alias("h"), pos.alias("p"), neg.alias("q"))
    for r in got.collect():
        assert (r["h"]["pos"], r["h"]["neg"]) == (r["p"], r["q"])


def test_select_scoring_input_rules(spark):
    rows = [("1", "a b c", 3), ("2", "", 1), ("3", None, 1), ("4", "one", None), ("5", " ", 2)]
    df = spark.createDataFrame(rows, "review_id string, comments string, tokens_ct int")
    got = sorted(r["review_id"] for r in SC.select_scoring_input(df, max_tokens=2, max_rows=0).collect())
    assert got == ["5"]  # blank text passes the non-empty check; NULL token count drops
    got = sorted(r["review_id"] for r in SC.select_scoring_input(df, max_rows=2).collect())
    assert len(got) == 2


def test_scorer_may_return_objects_and_concurrency_cap(spark):
    def as_dict(texts):
        return {"results": [{"label": "POSITIVE", "confidence": 0.5} for _ in texts]}
    df = spark.createDataFrame([(str(i), "x") for i in range(20)], "review_id string, comments string").repartition(6)
    out = SC.score_batches(df, as_dict, base_sleep=0.0, max_concurrency=2)
    assert out.rdd.getNumPartitions() == 2
    assert {(r.sentiment_label, r.parse_status) for r in out.collect()} == {("POSITIVE", "ok")}


def test_pieces_of_a_wide_batch_are_small():
    """A worker's rows leave it in pieces of a few MB whose batches are those of the whole, however wide the rows."""
    texts = [chr(97 + i % 26) * 100_000 for i in range(203)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(203)), pa.array(texts)], ["id", "comments"])
    sizes = []

    def scorer(group):
        sizes.append(len(group))
        return group[0][0]
    out = list(SC._runner(scorer, 8, 1, 0.0, 1, 2)(iter([batch.slice(0, 0), batch, batch.slice(200)])))
    assert len(out) > 4 and all(b.nbytes < SC.SLICE_BYTES + 9 * 100_100 for b in out)
    assert sizes == [8] * 25 + [3, 3]
    lists = [rows for b in out for rows in b.column(0).to_pylist()]
    assert [r["id"] for rows in lists for r in rows] == [*range(203), 200, 201, 202]
    assert [r["comments"] for rows in lists for r in rows] == texts + texts[200:]
    assert [a for b in out for a in b.column(1).to_pylist()] == [rows[0]["comments"][0] for rows in lists]


def test_texts_are_sent_once(spark):
    """Whole texts that are strings already are not copied into a second column; others are."""
    df = spark.createDataFrame([("1", "good", 7), ("2", None, 8)], "review_id string, comments string, k int")
    sent = lambda **how: SC.score_batches(df, _Echo(), base_sleep=0.0, **how)._jdf.queryExecution().analyzed().toString()
    assert "_shown" not in sent()
    assert "_shown" in sent(max_chars=2) and "_shown" in sent(text_col="k")
    for how in ({}, {"max_chars": 9}, {"text_col": "k"}, {"text_col": "COMMENTS"}):
        out = {tuple(r) for r in SC.score_batches(df, _Echo(), base_sleep=0.0, **how).collect()}
        good = "NEGATIVE" if how.get("text_col") == "k" else "POSITIVE"
        assert out == {("1", "good", 7, good, 0.75, "ok"), ("2", None, 8, "NEGATIVE", 0.75, "ok")}
