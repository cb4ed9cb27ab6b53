"""Review sentiment scoring at scale.

Pipeline
--------
``select_scoring_input``  non-empty text -> token cap -> seeded sample -> row cap
``score_batches``         ``mapInArrow``: rows of each partition are grouped
                          into batches of ``batch_size``; a pluggable scorer
                          turns one batch of texts into one reply string
                          (the model's JSON).  A batch leaves the Python
                          worker as one row, its rows in a list beside the
                          reply; the reply is parsed once, then the rows are
                          unpacked by position inside their own batch.
``parse_model_reply``     JVM-side: first ``{`` .. last ``}`` -> ``from_json``
                          -> the row's item -> label / score / parse_status.
``ledger``                (module) remembers replies, so reruns ask only for
                          what failed or is new.
``lexicon_score``         an offline scorer: word hits against a fixed word
                          list per row (an Arrow-batched pandas UDF), no
                          shuffle.

Concurrency against a remote model is the number of partitions of the
input (``parallelism`` repartitions round-robin).  A retried task re-sends
the same batches (the partition contents are deterministic), and output rows
are keyed, so a lost executor does not duplicate or lose rows.
"""

from __future__ import annotations

import json
import random
import re
import sys
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgelens.functions import exprs as X
from lodgelens.operators.sampling import sample_cap, sample_fraction

# ---------------------------------------------------------------------------
# The scorer contract shared with the reference.
# ---------------------------------------------------------------------------
LABELS = ["POSITIVE", "NEGATIVE"]
DEFAULT_LABEL = "NEGATIVE"
DEFAULT_SCORE = 0.0
BATCH_SIZE = 8
MAX_RETRIES = 3
BASE_SLEEP_SEC = 0.6
#: Rows and replies leave a worker in pieces of about so many bytes (one batch at least).
SLICE_BYTES = 4 << 20

# What a remote model is asked; the wording is ours and no result depends on it.
TASK = ("Judge the mood of each guest review below. Answer with one JSON object and nothing else: a key "
        "results that lists, in the order of the reviews, an object with label (POSITIVE or NEGATIVE) "
        "and confidence (a number from 0 to 1).")

# The offline lexicon (lower-case English words).
POSITIVE_WORDS = [
    "good", "great", "excellent", "amazing", "wonderful", "lovely", "perfect", "best",
    "nice", "clean", "comfortable", "friendly", "helpful", "quiet", "beautiful", "recommend",
    "fantastic", "spacious", "cosy", "cozy", "love", "loved", "convenient", "easy",
]
NEGATIVE_WORDS = [
    "bad", "terrible", "awful", "dirty", "noisy", "rude", "broken", "poor",
    "worst", "horrible", "disappointing", "disappointed", "smelly", "uncomfortable", "small",
    "cold", "unsafe", "cancelled", "cramped", "never", "problem", "complaint",
]
LEXICON_TOKEN_PATTERN = "[^a-z]+"

REPLY_SCHEMA = "struct<results: array<struct<label: string, confidence: string>>>"

Scorer = Callable[[list[str]], str]

# The batch runner and the offline scorer run in Python workers.  Shipping this
# module by value means workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ----------------------------------------------------------------- selection

def select_scoring_input(stage: DataFrame, max_tokens: int = 0, sample_frac: float = 0.0,
                         max_rows: int = 0, seed: int = 42, key: str = "review_id",
                         text_col: str = "comments", tokens_col: str = "tokens_ct") -> DataFrame:
    """Rows to score: non-empty text, token cap (0 = off; NULL count drops),
    seeded Bernoulli sample (0 = off), seeded row cap (0 = off, the default)."""
    df = stage.where(F.col(text_col).isNotNull() & (F.length(F.col(text_col)) > 0))
    if max_tokens and tokens_col in df.columns:
        df = df.where(F.col(tokens_col) <= max_tokens)
    df = sample_fraction(df, sample_frac, seed, key)
    return sample_cap(df, max_rows, seed, key)


# -------------------------------------------------------------------- prompt

def build_prompt(texts: list[str], max_chars: int | None = None) -> str:
    """The task and the texts as a JSON list (for remote models); whole texts unless ``max_chars`` is given."""
    reviews = [{"review": i, "text": (t or "")[:max_chars]} for i, t in enumerate(texts, 1)]
    return f"{TASK}\n{json.dumps(reviews, ensure_ascii=False, indent=1)}"


# -------------------------------------------------------------- reply parser

def reply_items(reply: Column) -> Column:
    """The reply's results: the array in its first ``{`` .. last ``}``, or NULL."""
    obj = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    return F.from_json(F.nullif(obj, F.lit("")), REPLY_SCHEMA).getField("results")


def item_result(answered: Column, items: Column, n: Column, pos: Column) -> Column:
    """Label, score and status of item ``pos`` (0-based) of parsed ``items`` for ``n`` texts (see ``parse_model_reply``)."""
    count_ok = F.coalesce(F.size(items) == n, F.lit(False))
    item = F.try_element_at(items, (pos + 1).cast("int"))
    raw_label = F.upper(item.getField("label"))
    raw_conf = item.getField("confidence")
    conf = raw_conf.try_cast("double")
    bad_item = item.isNull() | (raw_conf.isNotNull() & conf.isNull()) | F.isnan(F.coalesce(conf, F.lit(0.0)))
    status = (F.when(~answered, "failed")
               .when(items.isNull(), "no_json")
               .when(~count_ok, "count_mismatch")
               .when(bad_item, "bad_item")
               .otherwise("ok"))
    good = status == "ok"
    label = F.when(good & raw_label.isin(*LABELS), raw_label).otherwise(F.lit(DEFAULT_LABEL))
    score = F.when(good, F.least(F.greatest(F.coalesce(conf, F.lit(DEFAULT_SCORE)), F.lit(0.0)),
                                 F.lit(1.0))).otherwise(F.lit(DEFAULT_SCORE))
    return F.struct(label.alias("sentiment_label"), score.alias("sentiment_score"),
                    status.alias("parse_status"))


def parse_model_reply(reply: Column, n: Column, pos: Column) -> Column:
    """Label, score and status of item ``pos`` (0-based) of a reply for ``n`` texts.

    * no JSON object, or a result count different from ``n``: the whole batch
      is NEGATIVE / 0.0 (status ``no_json`` / ``count_mismatch``; ``failed``
      when the scorer gave no reply at all);
    * label upper-cased; anything but POSITIVE/NEGATIVE becomes NEGATIVE with
      its confidence kept;
    * a missing confidence is 0.0; a non-numeric confidence or a null item
      makes that row NEGATIVE / 0.0 (``bad_item``);
    * confidence is clamped to [0, 1].
    """
    return item_result(reply.isNotNull(), reply_items(reply), n, pos)


# ------------------------------------------------------------ batch runner

def _as_reply_text(reply) -> str | None:
    """Scorers may answer with text or with the decoded JSON object."""
    if reply is None or isinstance(reply, str):
        return reply
    if isinstance(reply, (dict, list)):
        return json.dumps(reply)
    return str(reply)


def _call_with_retries(scorer: Scorer, texts: list[str], max_retries: int,
                       base_sleep: float) -> str | None:
    """The reply, or None when every try failed; waits grow by half and never exceed 30 s."""
    wait = base_sleep
    for left in reversed(range(max_retries)):
        try:
            return _as_reply_text(scorer(texts))
        except Exception:  # noqa: BLE001 - any scorer failure is retried
            if left and wait > 0:
                time.sleep(random.uniform(wait / 2, wait))
                wait = min(1.5 * wait, 30.0)
    return None


def _runner(scorer: Scorer, batch_size: int, max_retries: int, base_sleep: float, text_at: int, width: int):
    """Rows whose column ``text_at`` holds the text -> one row a batch: the list of its rows (their first ``width`` columns), and the reply."""
    def packed(part: pa.RecordBatch, replies: list) -> pa.RecordBatch:
        rows = pa.StructArray.from_arrays(part.columns[:width], fields=list(part.schema)[:width])
        starts = range(0, part.num_rows, batch_size)
        lists = pa.ListArray.from_arrays(pa.array([*starts, part.num_rows], pa.int32()), rows)
        return pa.RecordBatch.from_arrays([lists, pa.array(replies, pa.string())], ["_rows", "_reply"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, replies, size = 0, [], 0
            for i in range(0, batch.num_rows, batch_size):
                group = batch.slice(i, batch_size)
                texts = [t or "" for t in group.column(text_at).to_pylist()]
                replies.append(_call_with_retries(scorer, texts, max_retries, base_sleep))
                size += group.nbytes
                end = i + group.num_rows
                if size >= SLICE_BYTES or end == batch.num_rows:
                    yield packed(batch.slice(first, end - first), replies)
                    first, replies, size = end, [], 0
    return run


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal per-row work to ``partitions`` tasks (default: the cluster's parallelism).

    Always a round-robin repartition, which Spark makes deterministic on
    retry: asking a frame for its partition count would run its upstream.
    """
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def score_batches(df: DataFrame, scorer: Scorer, text_col: str = "comments",
                  batch_size: int = BATCH_SIZE, max_retries: int = MAX_RETRIES,
                  base_sleep: float = BASE_SLEEP_SEC, parallelism: int | None = None,
                  max_concurrency: int | None = None, max_chars: int = 0) -> DataFrame:
    """All input columns plus sentiment_label, sentiment_score, parse_status.

    Concurrent scorer calls = number of partitions: ``parallelism`` (default
    the cluster's default parallelism) and, for a rate-limited remote model,
    at most ``max_concurrency``.  The scorer sees at most ``max_chars``
    characters of a text (0: all).  Building the plan runs no job.
    """
    want = parallelism or df.sparkSession.sparkContext.defaultParallelism
    src = spread(df, min(want, max_concurrency) if max_concurrency else want)
    if not max_chars and dict(src.dtypes).get(text_col) == "string":  # the text itself, not a second copy of it
        shown, text_at = src, src.columns.index(text_col)
    else:
        text = F.col(text_col).cast("string")
        shown, text_at = src.select("*", (X.truncate_text(text, max_chars) if max_chars else text).alias("_shown")), len(src.columns)
    schema = T.StructType([T.StructField("_rows", T.ArrayType(T.StructType(src.schema.fields))),
                           T.StructField("_reply", T.StringType())])
    raw = shown.mapInArrow(_runner(scorer, batch_size, max_retries, base_sleep, text_at, len(src.columns)), schema)
    # parsed below the explode: once a batch
    batches = raw.select("_rows", F.col("_reply").isNotNull().alias("_answered"), reply_items(F.col("_reply")).alias("_items"))
    rows = batches.select(F.posexplode("_rows").alias("_pos", "_row"), "_answered", "_items", F.size("_rows").alias("_n"))
    result = item_result(F.col("_answered"), F.col("_items"), F.col("_n"), F.col("_pos"))
    done = rows.select("_row", result.alias("_p"))
    return done.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], "_p.sentiment_label", "_p.sentiment_score", "_p.parse_status")


# ------------------------------------------------------------------ lexicon

def _lexicon_hits(text, pos_words=frozenset(POSITIVE_WORDS), neg_words=frozenset(NEGATIVE_WORDS),
                  split=re.compile(LEXICON_TOKEN_PATTERN).split) -> tuple[int, int]:
    """(positive, negative) word hits over the whole text, tokens = runs of a-z."""
    tokens = split(text.lower()) if isinstance(text, str) else ()
    return (sum(1 for w in tokens if w in pos_words), sum(1 for w in tokens if w in neg_words))


def _lexicon_hits_batch(texts: pd.Series) -> pd.DataFrame:
    pairs = [_lexicon_hits(t) for t in texts]
    return pd.DataFrame(pairs if pairs else None, columns=["pos", "neg"], dtype="int32")


_LEXICON_UDF = []


def lexicon_hits(text: Column) -> Column:
    """Arrow-batched hit counts, struct<pos int, neg int>.  Measured 3x faster
    than the same rule as higher-order column functions, which Spark
    evaluates without code generation."""
    if not _LEXICON_UDF:  # built on first use: a pandas UDF needs a live session
        _LEXICON_UDF.append(F.pandas_udf(_lexicon_hits_batch, "pos int, neg int"))
    return _LEXICON_UDF[0](text)


def lexicon_counts(text: Column) -> tuple[Column, Column]:
    """Positive and negative word hits as pure column expressions (the same
    rule as ``lexicon_hits``; used to cross-check it)."""
    tokens = F.split(F.lower(F.coalesce(text, F.lit(""))), LEXICON_TOKEN_PATTERN)
    pos_words = F.array(*[F.lit(w) for w in POSITIVE_WORDS])
    neg_words = F.array(*[F.lit(w) for w in NEGATIVE_WORDS])
    pos = F.size(F.filter(tokens, lambda t: F.array_contains(pos_words, t)))
    neg = F.size(F.filter(tokens, lambda t: F.array_contains(neg_words, t)))
    return pos, neg


def lexicon_label_score(pos: Column, neg: Column) -> tuple[Column, Column]:
    """POSITIVE when positive hits outnumber negative ones; the score is the
    smoothed share of the winning side, (max + 1) / (pos + neg + 2)."""
    label = F.when(pos > neg, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE"))
    score = (F.greatest(pos, neg) + 1).cast("double") / (pos + neg + 2).cast("double")
    return label, score


def lexicon_score(df: DataFrame, text_col: str = "comments") -> DataFrame:
    """Offline sentiment: a narrow, per-row projection (no shuffle of its own)."""
    scored = spread(df).withColumn("_hits", lexicon_hits(F.col(text_col)))
    label, score = lexicon_label_score(F.col("_hits.pos"), F.col("_hits.neg"))
    return scored.withColumns({"sentiment_label": label, "sentiment_score": score}).drop("_hits")


class LexiconReplyScorer:
    """A local stand-in for the remote model: answers a batch with the JSON
    reply the model would send, using the same lexicon rule as
    ``lexicon_score``.  Picklable, so it ships to the Python workers."""

    def __call__(self, texts: list[str]) -> str:
        results = []
        for t in texts:
            p, q = _lexicon_hits(t)
            label = "POSITIVE" if p > q else "NEGATIVE"
            results.append({"label": label, "confidence": (max(p, q) + 1) / (p + q + 2)})
        return json.dumps({"results": results})


class ScheduledFailures:
    """``scorer``, but a batch that holds a text whose length is a multiple of ``every`` fails.  For tests and drills."""

    def __init__(self, scorer: Scorer, every: int):
        self.scorer, self.every = scorer, every

    def __call__(self, texts: list[str]) -> str:
        if any(len(t) % self.every == 0 for t in texts):
            raise RuntimeError("a failure on schedule")
        return self.scorer(texts)


class ConstantReplyScorer:
    """Answers every text alike."""

    def __init__(self, label: str, confidence: float):
        self.item = {"label": label, "confidence": confidence}

    def __call__(self, texts: list[str]) -> str:
        return json.dumps({"results": [self.item] * len(texts)})
