"""Scoring that can be taken up again: a ledger of the replies already paid for.

The ledger is a Parquet folder of (review_id, text_key, label, score, status),
one part per wave of scoring.  A review is asked about only if the ledger holds
no reply for its id and text (sha256), so a rerun, a retry after a lost job or
a day that is curated anew pays for what is new or failed before, and an edited
text is asked about again.

Only usable replies are recorded.  Rows whose batch failed, came back without
JSON or with a wrong count get the conservative default in the result and are
asked about next time.  Waves (by hash, so about even) bound what a job that
dies loses: a wave's replies are in the ledger before the next one starts.

Repeated rows (same id and text) are asked about once.  If two runs at once
recorded the same review, the reply with the greater (label, score) counts, on
every read.  A null id is a review id of its own; a null text counts as empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelens.operators import scoring as SC
from lodgelens.sources import storage

#: What of a reply is worth keeping: the item was there and could be read, or was there and couldn't.
USABLE = ["ok", "bad_item"]
REPLIES = "review_id string, text_key string, sentiment_label string, sentiment_score double, parse_status string"
KEY = ["review_id", "text_key"]


def text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _parts(spark: SparkSession, root: str) -> list[str]:
    base = root.rstrip("/")
    return [f"{base}/{n}" for n in storage.names(spark, base, folders=True)
            if n.startswith("part=") and storage.exists(spark, f"{base}/{n}/_SUCCESS")]


def replies(spark: SparkSession, root: str) -> DataFrame:
    """One reply per (review_id, text_key) of the ledger; parts of jobs that died are passed over."""
    parts = _parts(spark, root)
    if not parts:
        return spark.createDataFrame([], REPLIES)
    best = F.max(F.struct("sentiment_label", "sentiment_score", "parse_status")).alias("r")
    return spark.read.schema(REPLIES).parquet(*parts).groupBy(*KEY).agg(best).select(*KEY, "r.*")


def record(scored: DataFrame, root: str) -> str:
    """Add the usable replies of ``scored`` (KEY and the reply columns) as one part."""
    path = f"{root.rstrip('/')}/part={uuid.uuid4().hex}"
    names = [c.split()[0] for c in REPLIES.split(", ")]
    scored.select(*names).where(F.col("parse_status").isin(*USABLE)).write.parquet(path)
    return path


def compact(spark: SparkSession, root: str) -> None:
    """Merge the ledger's parts into one; for when no run adds to it.

    The merged part is whole before the old ones go, and a reply that is in
    both counts once.
    """
    old = _parts(spark, root)
    if len(old) > 1:
        replies(spark, root).write.parquet(f"{root.rstrip('/')}/part={uuid.uuid4().hex}")
        for path in old:
            storage.remove(spark, path)


def _same_key(a: DataFrame, b: DataFrame) -> Column:
    """Ids compared null-safely, text keys plainly (they are never null)."""
    return a["review_id"].eqNullSafe(b["review_id"]) & (a["text_key"] == b["text_key"])


def unanswered(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row (review_id, text_key, comments) per review of ``rows`` without a reply.

    Keys meet the ledger without their texts; only the texts of what is to be
    asked about are fetched.
    """
    keys = rows.select(*KEY).distinct()
    new = keys.join(ledger.select(*KEY), _same_key(keys, ledger), "left_anti").alias("n")
    on = F.col("n.review_id").eqNullSafe(F.col("t.review_id")) & (F.col("n.text_key") == F.col("t.text_key"))
    return rows.select(*KEY, "comments").alias("t").join(new, on, "left_semi").groupBy(*KEY).agg(F.first("comments").alias("comments"))


def score_resumable(rows: DataFrame, scorer: SC.Scorer, root: str, waves: int = 1, key: str = "review_id",
                    text_col: str = "comments", **runner) -> DataFrame:
    """``rows`` with sentiment_label, sentiment_score, parse_status, asking only for what the ledger lacks.

    Runs the scoring (one job a wave) before it returns; the result reads the
    ledger.  ``parse_status`` is ``failed`` where there is still no reply.
    ``runner`` goes to ``score_batches``.
    """
    spark = rows.sparkSession
    taken = {"_id", "_text_key", "_reply"} & set(rows.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are this function's own")
    keyed = rows.withColumns({"_id": F.col(key).cast("string"), "_text_key": text_key(F.col(text_col))})
    asked = keyed.select(F.col("_id").alias("review_id"), F.col("_text_key").alias("text_key"), F.col(text_col).cast("string").alias("comments"))
    for wave in range(waves):
        part = asked.where(F.pmod(F.xxhash64("review_id", "text_key"), F.lit(waves)) == wave) if waves > 1 else asked
        scored = SC.score_batches(unanswered(part, replies(spark, root)), scorer, "comments", **runner)
        record(scored, root)
    known = replies(spark, root).select(F.col("review_id").alias("_l_id"), F.col("text_key").alias("_l_key"),
                                        F.struct("sentiment_label", "sentiment_score", "parse_status").alias("_reply"))
    out = keyed.join(known, F.col("_id").eqNullSafe(F.col("_l_id")) & (F.col("_text_key") == F.col("_l_key")), "left")
    default = F.struct(F.lit(SC.DEFAULT_LABEL).alias("sentiment_label"), F.lit(SC.DEFAULT_SCORE).alias("sentiment_score"),
                       F.lit("failed").alias("parse_status"))
    return out.withColumn("_reply", F.coalesce("_reply", default)).select(*[F.col(c) for c in rows.columns], "_reply.*")
