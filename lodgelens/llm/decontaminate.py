"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by size.  For each partition, documents are cut into
overlapping windows of twice the partition's largest item, so that any
passage as long as an item lies whole inside some window and the window's
Jaccard similarity with the item is bounded below, however long the document
is.  An item and a window whose MinHash values agree in some band (one value
each) are candidates.  A window's value can agree only if the window holds the
item's least shingle under that hash, so windows without any item's least
shingle are passed over without computing their values.  Candidates are
verified by exact containment: the share of the item's distinct shingles that
the whole document holds.

Items are taken in blocks of about ``ITEM_BLOCK`` (by hash of the id), each sent to all tasks, so
memory is bounded for any number of items; documents are read once per block.

A null or empty text holds no shingle; such documents match nothing, and such
items are found nowhere.  A text with fewer than five words is one shingle.
Rows that repeat an id are one document (its texts' shingles are verified row
by row) or one item each.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

HASHES = 64
ITEM_BLOCK = 20_000
#: Sizes of one partition differ by at most this factor.
RATIO = 1.5


def ordered_shingles(data: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the shingles in text order, repeats kept."""
    row, start, end = C.words(data, at)
    if not len(row):
        return row, np.zeros(0, np.uint64)
    word = C.span_hashes(C.LOWER[data], start, end)
    count = np.bincount(row, minlength=len(at) - 1)
    left = np.cumsum(count)[row] - np.arange(len(row))
    total = np.zeros(len(word), np.uint64)
    for k in range(size):
        take = np.zeros(len(word), np.uint64)
        take[:len(word) - k] = word[k:]
        take[left <= k] = 0
        total = C.mix(total * np.uint64(C.PRIME) + take + np.uint64(k + 1))
    keep = (left >= size) | ((left == count[row]) & (count[row] < size))
    return row[keep], total[keep]


def values(sh: np.ndarray) -> np.ndarray:
    """HASHES hash values (columns) of each shingle."""
    return C.mix(sh[:, None] ^ (np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(C.PRIME))[None])


class Items:
    """A block of items: shingle sets, partitions by size, least shingles and MinHash values."""

    def __init__(self, ids: np.ndarray, texts: list):
        row, sh = C.shingles(*C.utf8(pa.array(texts, pa.string())))
        cut = np.searchsorted(row, np.arange(len(texts) + 1))
        self.sets = [sh[a:b] for a, b in zip(cut, cut[1:])]
        self.ids, self.size = ids, np.diff(cut)
        real = np.flatnonzero(self.size > 0)
        part = np.floor(np.log(np.maximum(self.size, 1)) / np.log(RATIO)).astype(int)
        self.partitions = []  # (window, {band value: items})
        least = [np.zeros(0, np.uint64)]
        for p in np.unique(part[real]):
            table: dict[tuple[int, int], list[int]] = {}
            members = real[part[real] == p]
            for i in members:
                v = values(self.sets[i])
                least.append(self.sets[i][v.argmin(0)])
                for k, x in enumerate(v.min(0).tolist()):
                    table.setdefault((k, x), []).append(int(i))
            self.partitions.append((int(self.size[members].max()), table))
        self.least = np.unique(np.concatenate(least))
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.least >> np.uint64(42)).astype(np.int64)] = True

    def hits(self, sh: np.ndarray) -> np.ndarray:
        """Positions of shingles that are some item's least."""
        at = np.flatnonzero(self.bits[(sh >> np.uint64(42)).astype(np.int64)])
        where = np.minimum(np.searchsorted(self.least, sh[at]), max(len(self.least) - 1, 0))
        return at[self.least[where] == sh[at]] if len(self.least) else at[:0]

    def found(self, sh: np.ndarray, hits: np.ndarray) -> set[int]:
        """Items that agree in some band with a window of the document's shingles ``sh``."""
        out: set[int] = set()
        for longest, table in self.partitions:
            last = max(0, (len(sh) - 1) // longest - 1)
            near = np.unique(np.concatenate([hits // longest - 1, hits // longest]))
            for w in np.unique(np.clip(near, 0, last)).tolist():
                window = sh[w * longest:] if w == last else sh[w * longest:(w + 2) * longest]
                for k, x in enumerate(values(window).min(0).tolist()):
                    out.update(table.get((k, x), ()))
        return out


def _pass(docs: DataFrame, rows: list, threshold: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), [r[1] for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*sent.value)
        for batch in C.slim(batches, 1):
            out = []
            for i, j, data, at in C.pieces(batch.column(1)):
                row, sh = ordered_shingles(data, at)
                hits = items.hits(sh)
                for d in np.unique(row[hits]).tolist():
                    a, b = np.searchsorted(row, [d, d + 1])
                    own = np.unique(sh[a:b])
                    for k in sorted(items.found(sh[a:b], hits[(hits >= a) & (hits < b)] - a)):
                        held = len(np.intersect1d(own, items.sets[k], assume_unique=True))
                        if held >= threshold * items.size[k] - 1e-9:
                            out.append((batch.column(0)[i + d].as_py(), int(items.ids[k]), held, int(items.size[k])))
            cols = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "held", "item_shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, item_id long, held long, item_shingles long")


def contained(spark: SparkSession, docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, held, item_shingles: items of which a document holds ``threshold`` or more."""
    items = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    block = items.withColumn("b", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = None
    for b in range(blocks):  # a bounded block of items at a time, against all documents
        part = _pass(docs, block.where(F.col("b") == b).select("item_id", "text").collect(), threshold)
        part = C.stored(part, "contained") if blocks > 1 else part
        found = part if found is None else found.union(part)
    return found


def op10_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds 80% of the 5-word shingles or more."""
    return contained(spark, C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
