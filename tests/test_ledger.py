"""The reply ledger: nothing is asked about twice, failures are asked about again."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle

from lodgelens.operators import ledger as LE
from lodgelens.operators import scoring as SC

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KNOBS = dict(base_sleep=0.0, max_retries=1, batch_size=1)


class _Notes:
    """Writes a file for every text that it is asked about."""

    def __init__(self, folder, label="POSITIVE", fail=()):
        self.folder, self.label, self.fail = folder, label, fail

    def __call__(self, texts):
        import uuid
        for t in texts:
            with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
                f.write(t)
        if any(t in self.fail for t in texts):
            raise RuntimeError("no")
        return json.dumps({"results": [{"label": self.label, "confidence": 0.75}] * len(texts)})


def _asked(folder):
    found = sorted(open(os.path.join(folder, n)).read() for n in os.listdir(folder))
    for n in os.listdir(folder):
        os.remove(os.path.join(folder, n))
    return found


@pytest.fixture()
def notes(tmp_path):
    (tmp_path / "asked").mkdir()
    return str(tmp_path / "asked")


def _rows(spark, *rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "review_id string, comments string, n int").repartition(3)


def _got(df):
    return sorted((str(r.review_id), str(r.comments), r.sentiment_label, r.parse_status) for r in df.collect())


def test_a_rerun_asks_only_for_failures_and_news(spark, tmp_root, notes):
    rows = [("1", "a"), ("2", "b"), ("3", "c"), ("3", "c"), (None, "d")]
    one = LE.score_resumable(_rows(spark, *rows), _Notes(notes, fail=("b",)), tmp_root, **KNOBS)
    assert _got(one) == [("1", "a", "POSITIVE", "ok"), ("2", "b", "NEGATIVE", "failed"), ("3", "c", "POSITIVE", "ok"),
                         ("3", "c", "POSITIVE", "ok"), ("None", "d", "POSITIVE", "ok")]
    assert one.columns == ["review_id", "comments", "n", "sentiment_label", "sentiment_score", "parse_status"]
    assert _asked(notes) == ["a", "b", "c", "d"]  # equal rows once
    # review 1 has another text now, 4 is new
    rows = [("1", "a2"), ("4", "e"), *rows[1:]]
    two = LE.score_resumable(_rows(spark, *rows), _Notes(notes, "NEGATIVE"), tmp_root, **KNOBS)
    assert _asked(notes) == ["a2", "b", "e"]
    assert [(i, s) for i, _, s, _ in _got(two)] == [("1", "NEGATIVE"), ("2", "NEGATIVE"), ("3", "POSITIVE"), ("3", "POSITIVE"), ("4", "NEGATIVE"), ("None", "POSITIVE")]
    LE.score_resumable(_rows(spark, *rows), _Notes(notes), tmp_root, **KNOBS).collect()
    assert _asked(notes) == []


def test_useless_replies_are_not_kept(spark, tmp_root):
    for reply, status in (("sorry", "no_json"), (json.dumps({"results": []}), "count_mismatch")):
        out = LE.score_resumable(_rows(spark, ("1", "a")), lambda texts, r=reply: r, tmp_root, **KNOBS)
        assert [r.parse_status for r in out.collect()] == ["failed"], status
    assert LE.replies(spark, tmp_root).count() == 0
    out = LE.score_resumable(_rows(spark, ("1", "a")), lambda texts: json.dumps({"results": [{"label": "x", "confidence": "high"}]}), tmp_root, **KNOBS)
    assert [r.parse_status for r in out.collect()] == ["bad_item"] and LE.replies(spark, tmp_root).count() == 1


def test_a_lost_job_keeps_the_waves_before(spark, tmp_root, notes, monkeypatch):
    rows = [(str(i), f"t{i}") for i in range(40)]
    whole, done = LE.record, []

    def dies(scored, root):
        if len(done) == 2:
            raise RuntimeError("driver gone")
        done.append(whole(scored, root))
        return done[-1]
    monkeypatch.setattr(LE, "record", dies)
    with pytest.raises(RuntimeError, match="driver gone"):
        LE.score_resumable(_rows(spark, *rows), _Notes(notes), tmp_root, waves=4, **KNOBS)
    first = _asked(notes)
    assert 5 < len(first) < 35
    monkeypatch.undo()
    out = LE.score_resumable(_rows(spark, *rows), _Notes(notes), tmp_root, waves=4, **KNOBS)
    assert out.where("parse_status = 'ok'").count() == 40
    assert sorted(first + _asked(notes)) == sorted(t for _, t in rows)


def test_parts_of_dead_jobs_and_double_replies(spark, tmp_root):
    one = spark.createDataFrame([("1", "k", "NEGATIVE", 0.5, "ok"), ("2", "k", "POSITIVE", 0.5, "failed")], LE.REPLIES)
    two = spark.createDataFrame([("1", "k", "POSITIVE", 0.25, "ok"), (None, "k", "POSITIVE", 1.0, "ok")], LE.REPLIES)
    LE.record(one, tmp_root), LE.record(two, tmp_root)
    os.remove(os.path.join(LE.record(one.selectExpr("'9' as review_id", "text_key", "sentiment_label", "sentiment_score", "parse_status"), tmp_root), "_SUCCESS"))
    want = [("1", "POSITIVE"), ("None", "POSITIVE")]
    assert sorted((str(r.review_id), r.sentiment_label) for r in LE.replies(spark, tmp_root).collect()) == want
    LE.compact(spark, tmp_root)
    assert len(LE._parts(spark, tmp_root)) == 1
    assert sorted((str(r.review_id), r.sentiment_label) for r in LE.replies(spark, tmp_root).collect()) == want


def test_empty_input_and_clashing_columns(spark, tmp_root):
    none = _rows(spark, ("1", "a")).where("false")
    assert LE.score_resumable(none, _Notes("/nowhere"), tmp_root, **KNOBS).count() == 0
    with pytest.raises(ValueError):
        LE.score_resumable(none.withColumnRenamed("n", "_id"), _Notes("/nowhere"), tmp_root, **KNOBS)


def test_a_reply_is_parsed_once_a_batch(spark):
    """from_json stands below the explode of the batch's rows."""
    df = spark.range(20).selectExpr("cast(id as string) review_id", "'x' comments")
    plan = SC.score_batches(df, SC.LexiconReplyScorer())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.find("from_json") > plan.find("posexplode") > 0
