"""Line de-duplication by content-defined chunks of lines.

Borders come from the lines alone.  At every line that is not blank a chunk
opens, which goes on to the first line at which it has two such lines and
``LEAST`` words; one of the same kind runs back from every line; and a line of
``LONG`` words or more is a chunk of its own.  Chunks overlap, and together
those inside a passage cover each of its lines.  Of each chunk that occurs
more than once anywhere, the first occurrence stays and the lines of the
others go, after the bytes of the chunks have been compared by grouping on
their text.  So a line goes if, and only if, it lies in a passage of whole
lines (two that are not blank and ``LEAST`` words, or a line of ``LONG``) that
occurs earlier; what is cut always stays at its first place.  Blank lines
inside such a passage go with it.  Single short lines, however common, stay.

First is by doc_id (null first), hash of the text, then place.  A null text
stays null, and an empty one empty.  Rows are told apart by doc_id and text:
rows equal in both are one document and are cut alike.  Columns other than
doc_id and text are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

LONG, LEAST = 50, 20
KEY = ["id", "t1", "t2"]


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first line, last line, first byte, end byte) of every chunk; lines are numbered inside their row."""
    breaks = np.flatnonzero(data == 10)
    start, end = np.sort(np.r_[at[:-1], breaks + 1]), np.sort(np.r_[at[1:], breaks])
    lines = np.diff(np.searchsorted(breaks, at)) + 1
    row = np.repeat(np.arange(len(lines)), lines)
    number = np.arange(len(row)) - np.repeat(np.cumsum(lines) - lines, lines)
    words = np.bincount(np.searchsorted(start, C.words(data, at)[1], "right") - 1, minlength=len(start))
    held = np.flatnonzero(words)
    row, n = row[held], words[held]
    total, short = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(n < LONG)]
    i = np.arange(len(held))
    on = np.maximum(i + 1, np.searchsorted(total, total[:-1] + LEAST, "left") - 1)
    back = np.minimum(i - 1, np.searchsorted(total, total[1:] - LEAST, "right") - 1)
    forward, backward = on < len(held), back >= 0
    first, last = np.r_[i[forward], back[backward]], np.r_[on[forward], i[backward]]
    # long lines are chunks already
    keep = (row[first] == row[last]) & (short[last + 1] > short[first])
    alone = i[n >= LONG]
    pair = np.unique(np.r_[first[keep], alone] * (len(held) + 1) + np.r_[last[keep], alone])
    first, last = pair // (len(held) + 1), pair % (len(held) + 1)
    return row[first], number[held[first]], number[held[last]], start[held[first]], end[held[last]]


def chunks(text: str) -> Iterator[tuple[str, bool]]:
    """(line, whether it lies in a chunk) in order; joined by newlines they are the text."""
    _, first, last, _, _ = windows(*C.utf8(pa.array([text], pa.string())))
    lines = text.split("\n")
    inside = _covered(len(lines), zip(first.tolist(), last.tolist()))
    yield from zip(lines, inside)


def _covered(n: int, ranges) -> list[bool]:
    step = [0] * (n + 1)
    for first, last in ranges:
        step[first] += 1
        step[last + 1] -= 1
    return (np.cumsum(step[:-1]) > 0).tolist()


def _key(doc_id: Column, text: Column) -> list[Column]:
    text = text.cast("string")
    return [doc_id.cast("long").alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def counted_chunks(own: DataFrame, hash_bits: int = 64) -> DataFrame:
    """(id, t1, t2, first, last, hash) of every chunk of ``own(id, t1, t2, text)``."""
    mask = np.uint64((1 << hash_bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 3):
            for i, j, data, at in C.pieces(batch.column(3)):
                row, first, last, start, end = windows(data, at)
                of = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(of) for k in range(3)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                     pa.array((C.span_hashes(data, start, end) & mask).view(np.int64))], [*KEY, "first", "last", "hash"])

    return own.select(*KEY, "text").mapInArrow(run, "id long, t1 long, t2 long, first int, last int, hash long")


def _hinted(rows: DataFrame, column: str) -> DataFrame:
    """Hint a broadcast by the summed size of the arrays in ``column``, at most so many as a row's text has chunks."""
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.size(column)), F.lit(0))).first()
    return F.broadcast(rows) if 64 * n + 48 * size <= C.BROADCAST_BYTES else rows


def _beside(docs: DataFrame, doc_id: Column, text: Column, side: DataFrame, how: str) -> DataFrame:
    i, t1, t2 = _key(doc_id, text)
    return docs.join(side, i.eqNullSafe(F.col("_id")) & (t1 == F.col("_t1")) & (t2 == F.col("_t2")), how)


def _by_row(found: DataFrame, tag: str, *columns: str) -> DataFrame:
    rows = found.groupBy(*(F.col(c).alias(f"_{c}") for c in KEY)).agg(F.collect_set(F.struct(*columns)).alias("_chunks"))
    return _hinted(C.stored(rows, tag), "_chunks")


def _texts(own: DataFrame, hits: DataFrame) -> DataFrame:
    """(id, t1, t2, first, last, hash, chunk) of ``hits``."""
    rows = _beside(own, F.col("id"), F.col("text"), _by_row(hits, "line-hits", "first", "last", "hash"), "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 3):
            of, out = [], [[], [], [], []]
            for k, (text, held) in enumerate(zip(batch.column(3), batch.column(4))):
                lines = text.as_py().split("\n")
                for x in held.as_py():
                    of.append(k)
                    for c, v in zip(out, (x["first"], x["last"], x["hash"], "\n".join(lines[x["first"]:x["last"] + 1]))):
                        c.append(v)
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(of) for k in range(3)), *(pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int32(), pa.int64(), pa.string())))],
                [*KEY, "first", "last", "hash", "chunk"])

    return rows.select(*KEY, "text", "_chunks").mapInArrow(run, "id long, t1 long, t2 long, first int, last int, hash long, chunk string")


def dedup_lines(spark: SparkSession, docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """``docs`` without repeated passages in text; ``n_chunks`` (lines) and ``n_removed`` (lines cut) are added."""
    own = docs.select(*_key(F.col("doc_id"), F.col("text")), F.col("text").cast("string").alias("text"))
    found = C.stored(counted_chunks(own, hash_bits), "line-chunks")
    repeated = C.stored(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "line-repeated")
    hits = found.join(C.small(repeated, 16), "hash", "left_semi")
    place = F.struct(*KEY, "first", "last")
    # written: a join straight onto the aggregate keeps its partitioning, which cannot be split at a chunk that is everywhere
    groups = C.stored(_texts(own, hits).groupBy("hash", "chunk").agg(F.min(place).alias("origin")), "line-groups")
    clash = C.stored(groups.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "line-clashes")
    again = lambda rows, by: rows.join(by, [c for c in ("hash", "chunk") if c in rows.columns]).where(~place.eqNullSafe(F.col("origin"))).select(*KEY, "first", "last")
    extra = again(hits, C.stored(groups.join(C.small(clash, 16), "hash", "left_anti").select("hash", "origin"), "line-origins"))
    if not clash.isEmpty():  # several texts of one hash
        extra = extra.union(again(_texts(own, hits.join(C.small(clash, 16), "hash", "left_semi")), groups))
    few = _by_row(extra, "line-removed", "first", "last")
    rest = [c for c in docs.columns if c not in ("text", "n_chunks", "n_removed")]
    joined = _beside(docs.select(*rest, "text"), F.col("doc_id"), F.col("text"), few, "left").select(*rest, F.col("text").cast("string").alias("text"), "_chunks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, len(rest)):
            texts, total, removed = [], [], []
            for text, gone in zip(batch.column(len(rest)), batch.column(len(rest) + 1)):
                text, gone = text.as_py(), gone.as_py()
                lines = text.split("\n") if text is not None else []
                left = lines
                if gone:
                    cut = _covered(len(lines), ((g["first"], g["last"]) for g in gone))
                    left = [x for x, c in zip(lines, cut) if not c]
                texts.append(None if text is None else "\n".join(left))
                total.append(len(lines))
                removed.append(len(lines) - len(left))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                                             [*rest, "text", "n_chunks", "n_removed"])

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in rest) + ", text string, n_chunks long, n_removed long"
    return joined.mapInArrow(run, schema)


def op7_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the line chunks that occur earlier."""
    return dedup_lines(spark, C.table(spark, sf_dir, "documents").select("doc_id", "text"))
