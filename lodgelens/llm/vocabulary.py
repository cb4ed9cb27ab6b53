"""Word counts by class, and word tables that scoring tasks look words up in.

Here a word is a run of letters of the lower-cased text: ASCII letters and
every non-ASCII character count as letters, so the byte kernel applies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common as C

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def letter_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, hash) of every letter word."""
    spaced = np.where(LETTER[data], data, 32).astype(np.uint8)
    row, start, end = C.words(spaced, at)
    return row, start, end, C.span_hashes(spaced, start, end)


def lowered(col: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(col.cast(pa.large_string()), ""))


def word_counts(docs: DataFrame, kind: Column, by_document: bool) -> DataFrame:
    """(kind, word, n): occurrences of each word under each kind, or documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 1):
            kinds, codes = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for i, j, data, at in C.pieces(lowered(batch.column(1))):
                row, start, end, h = letter_words(data, at)
                if not len(row):
                    continue
                if by_document:
                    order = np.lexsort((h, row))
                    new = np.ones(len(order), bool)
                    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
                    row, start, end, h = (x[order[new]] for x in (row, start, end, h))
                code = codes[i:j][row]
                order = np.lexsort((h, code))
                cut = np.flatnonzero(np.r_[True, (h[order][1:] != h[order][:-1]) | (code[order][1:] != code[order][:-1])])
                first, n = order[cut], np.diff(np.r_[cut, len(order)])
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(kinds[code[first]].astype(object), pa.string()),
                    pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(start[first].tolist(), end[first].tolist())], pa.string()),
                    pa.array(n.astype(np.int64))], ["kind", "word", "n"])

    counts = docs.select(kind.cast("string").alias("kind"), F.col("text").cast("string").alias("text")).where("kind is not null").mapInArrow(
        run, "kind string, word string, n long")
    return counts.groupBy("kind", "word").agg(F.sum("n").alias("n"))


class Words:
    """Sorted word hashes, each with a row of numbers."""

    def __init__(self, hashes: np.ndarray, payload: np.ndarray):
        self.hashes, self.payload = hashes, payload

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row numbers in the table; -1 for words that it lacks."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


def hashed(table: DataFrame, width: int) -> DataFrame:
    """(hash, payload) of a ``table(word, payload array<float>)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in C.pieces(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(C.span_hashes(data, at[:-1], at[1:]).view(np.int64)), batch.column(1)[i:j]], ["hash", "payload"])

    return table.select("word", "payload").mapInArrow(run, "hash long, payload array<float>").dropDuplicates(["hash"])


def arrays(hashes: np.ndarray, payload: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``Words`` is made of."""
    hashes = hashes.view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], payload.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, width)[order]


def sent(rows: DataFrame, width: int, broadcast_bytes: int | None = None):
    """A broadcast of the (stored) ``rows(hash, payload)``, or None if they are more than ``broadcast_bytes`` in size."""
    if rows.count() * (8 + 4 * width) > (C.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return None
    got = rows.toArrow()
    flat = got.column("payload").combine_chunks() if len(got) else pa.array([], pa.list_(pa.float32()))
    flat = flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks)
    return rows.sparkSession.sparkContext.broadcast(arrays(got.column("hash").to_numpy().astype(np.int64), flat, width))


def scored(docs: DataFrame, table: DataFrame, width: int, score: Callable[[pa.Array, Words], list[pa.Array]], schema: str,
           broadcast_bytes: int | None = None) -> DataFrame:
    """``docs`` columns doc_id, text go in; doc_id and what ``score`` returns come out.

    ``table(word, payload)`` is sent whole to the tasks if it is at most
    ``broadcast_bytes`` in size.  If not, each distinct text is scored once:
    its distinct words are joined with the table by hash, a task's table is what
    its texts hold, and rows meet their text's result by the text's hash (128
    bits), so neither copies of a text nor rows that share an id pile up.
    """
    names = ["doc_id", *StructType.fromDDL(schema).names]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = C.stored(hashed(table, width), "word-table")

    table = sent(rows, width, broadcast_bytes)
    if table is not None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in C.slim(batches, 1):
                yield pa.RecordBatch.from_arrays([batch.column(0), *score(batch.column(1), Words(*table.value))], names)

        return docs.mapInArrow(run, f"doc_id long, {schema}")

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 2):
            for i, j, data, at in C.pieces(lowered(batch.column(2))):
                row, _, _, h = letter_words(data, at)
                order = np.lexsort((h, row))
                new = np.r_[True, (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])][:len(order)]
                of = pa.array(row[order[new]] + i)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(h[order[new]].view(np.int64))], ["t1", "t2", "hash"])

    key, whole = ["t1", "t2"], F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(1), whole).alias("t2"), "text")
    texts = keyed.groupBy(*key).agg(F.first("text").alias("text"), F.count("*").alias("size"))
    hits = (keyed.select(*key, "text").mapInArrow(distinct_words, "t1 long, t2 long, hash long").distinct().join(rows, "hash")
            .groupBy(*key).agg(F.collect_list(F.struct("hash", "payload")).alias("hits")))

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 3):
            found = batch.column(4).flatten()  # null lists flatten to nothing
            h = found.field("hash").to_numpy(zero_copy_only=False).astype(np.int64)
            _, first = np.unique(h, return_index=True)
            own = Words(*arrays(h[first], found.field("payload").take(pa.array(first)), width))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *score(batch.column(3), own)], [*key, "size", *names[1:]])

    per = (texts.join(hits, key, "left").select(*key, "size", "text", "hits")
           .mapInArrow(run_joined, f"t1 long, t2 long, size long, {schema}"))
    return C.met(keyed.select("doc_id", *key), C.stored(per, "text-scores"), key, None).select(*names)
