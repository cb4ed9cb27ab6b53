"""Toxic passages by maximum-scoring segments.

A word's score is its log-odds between toxic and other training documents
under an informative Dirichlet prior (the corpus frequencies, weighing as much
as all toxic text); words whose
log-odds are at least ``LEAST_Z`` standard deviations over 0 make the lexicon.
Every other word costs ``DRIFT``.  A linear-time scan finds all maximal
scoring segments of a document; a segment's score S becomes evidence
``lambda * S - ln(K * n)`` by the extreme-value law of such maxima in clean
text, and those over 0 are passages.  The sum of a document's evidence is
calibrated to a probability on all training documents.

A null or empty text, or one without lexicon words, has no passage and gets
the share of toxic documents among such training documents.  Without training
rows the score is 0.5 for none and predicted 0.  Rows that repeat a doc_id are
each scored.  Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import vocabulary as V

LEAST_Z = 3.0
MOST_SCORE, DRIFT = 6.0, 0.25
MOST_EVIDENCE = 50.0


def segments(at: list[int], score: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score).

    ``at`` are the places of positive words; each word between costs ``drift``.
    Linear in the number of positive words.
    """
    kept: list[list[float]] = []  # first, last, sum before, sum after
    total, last = 0.0, None
    for i, s in zip(at, score):
        if last is not None:
            total -= drift * (i - last - 1)
        new = [i, i, total, total + s]
        total, last = total + s, i
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j -= 1
            if j < 0 or kept[j][3] >= new[3]:
                # segments that begin no lower can never be joined from here on
                kept.append(new)
                break
            new = [kept[j][0], new[1], kept[j][2], new[3]]
            del kept[j:]
    return [(int(a), int(b), r - l) for a, b, l, r in kept]


class Scale:
    """The extreme-value law of segment scores in clean text."""

    def __init__(self, rates: list[tuple[float, float]]):
        """``rates``: (score, share of clean words that have it)."""
        self.k = max(sum(p for _, p in rates), 1e-12)
        low, high = 1e-6, 50.0
        for _ in range(100):
            x = (low + high) / 2
            total = sum(p * np.exp(min(x * s, 700.0)) for s, p in rates) + (1 - self.k) * np.exp(-x * DRIFT)
            low, high = (x, high) if total < 1 else (low, x)
        self.rate = low


def lexicon(train: DataFrame) -> tuple[DataFrame, Scale]:
    """(word, payload [score]) and the scale, from ``train(text, toxic)``."""
    counts = C.stored(V.word_counts(train, F.when(F.col("toxic") == 1, "1").otherwise("0"), by_document=True), "toxic-words")
    n = {r["kind"]: float(r["n"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    n1, n0 = n.get("1", 0.0), n.get("0", 0.0)
    all_ = max(n1 + n0, 1.0)
    y = counts.groupBy("word").agg(*[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"y{k}") for k in "10"])
    weight = max(n1, 1.0)
    y = y.withColumn("a", (F.col("y1") + F.col("y0")) * (weight / all_))
    odds = F.log((F.col("y1") + F.col("a")) / (n1 + weight - F.col("y1") - F.col("a"))) - F.log((F.col("y0") + F.col("a")) / (n0 + weight - F.col("y0") - F.col("a")))
    table = C.stored(y.withColumn("odds", odds).where((F.col("odds") > 0) & (F.col("odds") / F.sqrt(1 / (F.col("y1") + F.col("a")) + 1 / (F.col("y0") + F.col("a"))) >= LEAST_Z))
                     .select("word", F.least("odds", F.lit(MOST_SCORE)).alias("score"), ((F.col("y0") + 0.5) / (n0 + 1)).alias("share")), "toxic-lexicon")
    cells = table.groupBy((F.floor(F.col("score") * 8) / 8).alias("s")).agg(F.sum("share").alias("p")).collect()  # 8 * MOST_SCORE rows at most
    return table.select("word", F.array(F.col("score").cast("float")).alias("payload")), Scale([(float(r["s"]), float(r["p"])) for r in cells])


def scorer(scale: Scale):
    rate, k = scale.rate, scale.k

    def score(texts: pa.Array, words: V.Words) -> list[pa.Array]:
        evidence, passages = np.zeros(len(texts)), [[] for _ in range(len(texts))]
        for i, j, data, at in C.pieces(V.lowered(texts)):
            row, _, _, h = V.letter_words(data, at)
            found = words.find(h)
            first = np.searchsorted(row, np.arange(j - i + 1))
            hit = np.flatnonzero(found >= 0)
            for d in np.unique(row[hit]).tolist():
                own = hit[(hit >= first[d]) & (hit < first[d + 1])]
                n = int(first[d + 1] - first[d])
                for a, b, s in segments((own - first[d]).tolist(), words.payload[found[own], 0].tolist(), DRIFT):
                    e = rate * s - np.log(k * n)
                    if e > 0:
                        passages[i + d].append({"first_word": a, "last_word": b, "evidence": float(e)})
                        evidence[i + d] += e
        kind = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("evidence", pa.float64())]))
        return [pa.array(evidence), pa.array(passages, kind)]

    return score


def calibrate(cells: pd.DataFrame) -> tuple[float, float, float]:
    """Base log-odds without evidence; offset and slope with some: fitted on (e, n, toxic) cells."""
    none, some = cells[cells.e <= 0], cells[cells.e > 0]
    base = np.log((none.toxic.sum() + 0.5) / (none.n.sum() - none.toxic.sum() + 0.5))
    x, n, y = np.log1p(some.e.to_numpy(float)), some.n.to_numpy(float), some.toxic.to_numpy(float)
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(30):  # Newton steps with a light pull to 0
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hess = design.T @ (design * (n * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        w = w + np.linalg.solve(hess, design.T @ (y - n * p) - 1e-2 * w)
    return float(base), float(w[0]), float(max(w[1], 0.0))


def toxic_scores(spark: SparkSession, docs: DataFrame, train: DataFrame, labels: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """doc_id, score, predicted, passages of ``docs``; learned from ``train`` (rows of docs) and ``labels(doc_id, toxic)``."""
    docs, train = docs.select("doc_id", "text"), train.select("doc_id", "text")
    labels = C.stored(labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    known = C.small(labels, 24)
    table, scale = lexicon(train.join(known, "doc_id").select("text", "toxic"))
    found = C.stored(V.scored(docs, table, 1, scorer(scale), "evidence double, passages array<struct<first_word:int,last_word:int,evidence:double>>", broadcast_bytes), "toxic-evidence")
    ids = train.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    cells = (found.join(known, "doc_id").join(ids, "doc_id", "left_semi")
             .groupBy(F.round(F.least("evidence", F.lit(MOST_EVIDENCE)), 1).alias("e"))  # 10 * MOST_EVIDENCE + 1 rows at most
             .agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).toPandas())
    base, offset, slope = calibrate(cells) if len(cells) else (-1.0, 0.0, 1.0)
    e = F.least("evidence", F.lit(MOST_EVIDENCE))
    odds = F.when(e <= 0, F.lit(base)).otherwise(F.lit(offset) + F.lit(slope) * F.log1p(e))
    score = 1 / (1 + F.exp(-odds))
    return found.select("doc_id", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "passages")


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all ``documents``, learned from labelled ones whose crc32 mod 5 is not 0."""
    docs = C.table(spark, sf_dir, "documents")
    out = toxic_scores(spark, docs, docs.where(~C.held_out()), C.table(spark, sf_dir, "labels"))
    return out.select("doc_id", C.held_out().alias("held_out"), "score", "predicted", "passages")
