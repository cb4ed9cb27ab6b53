"""Importance resampling towards a target: hashed word runs, weights, Gumbel top draw.

A feature is a run of 1 to ``most`` words, joined by one space, and falls in the
bucket of its crc32.  Texts are cut at newlines, which part words anyway: each
distinct line's features are found once, and its buckets count once for every
occurrence of the line.  Runs that go across a newline are counted for the text
that holds them.  A bucket's gain is its log ratio between target and corpus in
thousandths, with one added to each bucket; a text's weight is the sum of the
gains of its features, the line sums looked up by the line's hash (128 bits).

Lines that make up a thousandth of all lines or more (at most 1,000, hence
broadcast) meet their texts on the spot; all others by a shuffle, in which no
line then has more than a thousandth of the rows.

Of the texts with at least ``least_words`` words the drawn share are those of
the highest scores (weight plus Gumbel noise from the sha256 of doc_id), ties to
the smaller doc_id (null last).  Places are numbered per range of the sorted
rows plus the rows of the ranges before, never in one task.

A null or empty text has no words, weight 0 and no rank.  A null doc_id draws as
the empty id.  Rows that repeat a doc_id, also equal ones, stand for themselves
(each counts in the corpus); a tie between them goes by place in the input.
Texts are worked on whole.  Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 10_000
#: A line with one in so many of all lines' occurrences is looked up from a broadcast.
HOT = 1000

#: Bytes of words: digits, letters and all that isn't ASCII (A-Z are lowered first).
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, end) of every word, and the lowered bytes with blanks between words."""
    low = C.LOWER[data]
    low = np.where(WORD_BYTE[low], low, 32).astype(np.uint8)
    return *C.words(low, at), low


def features(data: np.ndarray, at: np.ndarray, buckets: int, most: int, line: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every run of words, by row, and words per row; with ``line`` numbers of bytes, only runs over several lines."""
    row, start, end, low = _words(data, at)
    words = np.bincount(row, minlength=len(at) - 1)
    h, raw = C.span_hashes(low, start, end), low.tobytes()
    rows, found, gram = [], [], np.zeros(len(row), np.uint64)
    for k in range(1, most + 1):
        n = max(len(row) - k + 1, 0)
        gram = C.mix(gram[:n] * np.uint64(C.PRIME) + h[k - 1:] + np.uint64(k))
        keep = row[:n] == row[k - 1:]
        if line is not None:
            keep &= line[start[:n]] != line[start[k - 1:]]
        i = np.flatnonzero(keep)
        _, first, place = np.unique(gram[i], return_index=True, return_inverse=True)
        crc = [zlib.crc32(b" ".join(raw[start[w]:end[w]] for w in range(j, j + k))) % buckets for j in i[first].tolist()]
        rows.append(row[i])
        found.append(np.array(crc, np.int32)[place] if len(crc) else np.zeros(0, np.int32))
    row, found = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return row[order], found[order], words


def _lists(row: np.ndarray, found: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.searchsorted(row, np.arange(n + 1)).astype(np.int32), pa.array(found, pa.int32()))


def _line_hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("l1"), F.xxhash64(F.lit(1), line).alias("l2"))


def _lines(text: Column) -> Column:
    """The text's lines but for empty ones."""
    return F.filter(F.split(text, "\n"), lambda x: x != "")


def distinct_lines(texts: DataFrame, buckets: int, most: int, tag: str) -> DataFrame:
    """l1, l2, n (occurrences), words, features (buckets, repeats kept) of each distinct line that has words."""
    lines = texts.select(F.explode(_lines(F.col("text"))).alias("line")).groupBy("line").agg(F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 3):
            for i, j, data, at in C.pieces(batch.column(3)):
                row, found, words = features(data, at, buckets, most)
                made = pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(3)), pa.array(words), _lists(row, found, j - i)],
                                                  ["l1", "l2", "n", "words", "features"])
                yield made.filter(pa.array(words > 0))

    keyed = lines.select(_line_hash(F.col("line")).alias("h"), "n", "line").select("h.l1", "h.l2", "n", "line")
    return C.stored(keyed.mapInArrow(run, "l1 long, l2 long, n long, words long, features array<int>"), tag)


def bucket_counts(held: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) of ``held(n, features)``: every feature counts n times; one row a bucket leaves each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            np.add.at(total, lists.flatten().to_numpy(zero_copy_only=False), np.repeat(batch.column(0).to_numpy(zero_copy_only=False), size))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    counts = held.select(F.col("n").cast("long"), "features").mapInArrow(run, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def crossing(buckets: int, most: int):
    """A column function: the buckets of a text's runs of words over more than one line."""

    def run(texts: pd.Series) -> pd.Series:
        col, out = pa.array(texts, pa.large_string()), []
        for i, j, data, at in C.pieces(col):
            row, found, _ = features(data, at, buckets, most, np.cumsum(data == 10))
            out += np.split(found, np.searchsorted(row, np.arange(1, j - i)))
        return pd.Series(out)

    return F.pandas_udf(run, "array<int>")


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Each bucket's gain in thousandths, rounded down; one number a bucket (a parameter) reaches the driver."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, into in ((corpus, s), (target, t)):
        for r in counts.collect():
            into[r.bucket] = r.n
    up = (t + 1).astype(float) * float(s.sum() + buckets)
    down = (s + 1).astype(float) * float(t.sum() + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def _weighed(held: DataFrame, names: list[str], gain: np.ndarray) -> DataFrame:
    """``names`` and n_features, weight of each row's ``features``."""
    kept = held.select(*names, "features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(names))
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.r_[0, np.cumsum(gain[lists.flatten().to_numpy(zero_copy_only=False)])]
            end = np.cumsum(size)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(size), pa.array(total[end] - total[end - size])], [*names, "n_features", "weight"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name in names)
    return kept.mapInArrow(run, f"{fields}, n_features long, weight long")


def weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, most: int = 1) -> DataFrame:
    """doc_id, row, words, n_features, weight of each row of ``docs`` (doc_id, text) towards the texts of ``target``."""
    def texts(df: DataFrame, *more: Column) -> DataFrame:
        return df.select(*more, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def across(text: Column) -> Column:
        return crossing(buckets, most)(text) if most > 1 else F.array().cast("array<int>")

    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"))
    rows = C.stored(rows.select("doc_id", "row", F.transform(_lines(F.col("text")), _line_hash).alias("lines"), across(F.col("text")).alias("features")), "line-lists")
    lines = distinct_lines(texts(docs), buckets, most, "lines")
    wanted = texts(target)
    one = F.lit(1).alias("n")
    corpus = bucket_counts(lines, buckets), bucket_counts(rows.select(one, "features"), buckets)
    aim = bucket_counts(distinct_lines(wanted, buckets, most, "target-lines"), buckets), bucket_counts(wanted.select(one, across(F.col("text")).alias("features")), buckets)
    both = (side[0].union(side[1]).groupBy("bucket").agg(F.sum("n").alias("n")) if most > 1 else side[0] for side in (corpus, aim))
    gain = gains(*both, buckets)

    line = C.stored(_weighed(lines, ["l1", "l2", "n", "words"], gain), "line-weights")
    all_lines = line.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(line.where(F.col("n") * HOT >= all_lines).withColumn("hot", F.lit(True)).drop("n"))
    held = rows.select("row", F.explode("lines").alias("h")).select("row", "h.l1", "h.l2").join(hot, ["l1", "l2"], "left")
    rest = held.where("hot is null").select("row", "l1", "l2").join(line.where(F.col("n") * HOT < all_lines), ["l1", "l2"])
    names = ["row", "words", "n_features", "weight"]
    parts = held.where("hot").select(*names).union(rest.select(*names))
    if most > 1:
        parts = parts.union(_weighed(rows.where(F.size("features") > 0), ["row"], gain).select("row", F.lit(0).cast("long"), "n_features", "weight"))
    per = parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in names[1:]])
    none = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in names[1:]]
    return rows.select("doc_id", "row").join(per, "row", "left").select("doc_id", "row", *none)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of the id, in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def numbered(df: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """``df`` with ``place``, 1, 2, 3... in ``order``: places in a range of the sorted rows plus the rows of the ranges before."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = C.stored(rows, tag).withColumns({"_range": F.shiftright("_at", 33), "_in": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = rows.groupBy("_range").agg((F.max("_in") + 1).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # one row a range
    ranges = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(ranges), "_range").select(*df.columns, (F.col("_before") + F.col("_in") + 1).alias("place"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024, buckets: int = BUCKETS, most: int = 1) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null unless drawn) of every row of ``docs``."""
    found = weights(docs, target, buckets, most)
    fit = (F.col("words") >= least_words).alias("fit")
    found = C.stored(found.select("doc_id", "row", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), fit), "scores")
    drawn = found.where("fit").count() * percent // 100
    placed = numbered(found, [F.desc("fit"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], "placed")
    return placed.select("doc_id", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))


def op13_line_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` weighed and drawn towards the texts of ``benchmark``."""
    return resample(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
