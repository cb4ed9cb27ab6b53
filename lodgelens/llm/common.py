"""Tables, shared scratch folders and the word kernel that the operators share.

Word rules (used by every operator that counts or shingles words): a word is a
run of characters other than U+0020 and U+0009..U+000D; only A-Z are lowered.
Both rules touch ASCII bytes alone, so the kernel works on UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sides of at most so many bytes (row count times row width) are broadcast.
BROADCAST_BYTES = 32 << 20
#: Tasks that the rows of a hot key are dealt to.
SALT = 64
#: Texts are worked on in pieces of about so many bytes (one text at least).
PIECE_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

PRIME = 0x9E3779B97F4A7C15
PRIME_INVERSE = pow(PRIME, -1, 1 << 64)
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write to a fresh shared folder and read back: cuts lineage, survives lost executors."""
    from lodgelens.session import scratch_path  # here: tasks get this module without the rest of the library

    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Hint a broadcast when the (stored) table's size is under BROADCAST_BYTES.

    Beyond it the table is returned as it is, and joins shuffle both sides.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def met(rows: DataFrame, table: DataFrame, key: str | list[str], row_bytes: int | None, size: str = "size") -> DataFrame:
    """``rows.join(table, key)`` with no key's rows in one task.

    ``table`` is stored, has each key once and in ``size`` about how many rows
    it meets.  A small table is broadcast (``row_bytes`` None: never).  For a
    larger one the keys with a thousandth of the rows or more are found: at
    most 1,000, whose keys alone are broadcast; their rows are dealt to
    ``SALT`` tasks, each with its copy of the table's row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if row_bytes is not None and table.count() * row_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), keys)
    total = table.agg(F.sum(size)).first()[0]
    hot = F.col(size) * 1000 >= total
    often = F.broadcast(table.where(hot).select(*keys, F.lit(True).alias("_hot")))
    dealt = rows.join(often, keys, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(SALT))).otherwise(F.lit(0)).cast("int"))
    salts = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0))))
    return dealt.drop("_hot").join(table.withColumn("_salt", salts), [*keys, "_salt"]).drop("_salt")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, mod 5, is 0.  A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str)
                              else doc_id.cast("string")) % 5 == 0, F.lit(True))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """PRIME**i and its inverse modulo 2**64 for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        up, down = np.full(size, PRIME, np.uint64), np.full(size, PRIME_INVERSE, np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _POWERS[0][:n], _POWERS[1][:n]


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the offsets of its rows; null counts as empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def slim(batches: Iterator[pa.RecordBatch], column: int, limit: int = 8 * PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of the text ``column`` (a row at least): batches count rows, not bytes."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + limit, "right")))
            yield batch.slice(i, j - i)
            i = j


def pieces(col: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    data, at = utf8(col)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, data[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end byte) of every word, in order."""
    inside = ~SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = at[:-1][at[:-1] < len(data)]
    opens[first] = inside[first]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = at[1:][at[1:] > 0] - 1
    closes[last] = inside[last]
    start = np.flatnonzero(opens)
    return np.searchsorted(at, start, "right") - 1, start, np.flatnonzero(closes) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: differences of one running polynomial."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(data: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct word shingles, sorted by row, then hash.

    A row with fewer than ``size`` words has its whole sequence as its one
    shingle; a row without words has none.
    """
    row, start, end = words(data, at)
    if not len(row):
        return row, np.zeros(0, np.uint64)
    word = span_hashes(LOWER[data], start, end)
    count = np.bincount(row, minlength=len(at) - 1)
    total = np.zeros(len(word), np.uint64)
    left = np.cumsum(count)[row] - np.arange(len(row))  # words from here to the row's end
    for k in range(size):
        take = np.zeros(len(word), np.uint64)
        take[:len(word) - k] = word[k:]
        take[left <= k] = 0
        total = mix(total * np.uint64(PRIME) + take + np.uint64(k + 1))
    head = left == count[row]
    keep = (left >= size) | (head & (count[row] < size))
    row, total = row[keep], total[keep]
    order = np.lexsort((total, row))
    row, total = row[order], total[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (total[1:] != total[:-1])
    return row[new], total[new]


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges(a, b)``.

    Labels spread to neighbours and then jump along their own pointers until
    nothing changes, so the rounds grow with the logarithm of the longest path.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), tag)
    label = stored(both.groupBy(F.col("a").alias("node"))
                   .agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("component")), tag)
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        step = label.join(near, "node").select("node", F.least("component", "m").alias("to"), F.col("component").alias("was"))
        step = stored(step, tag)
        jump = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
        moved = stored(step.join(jump, "to", "left")
                       .select("node", F.least("to", F.coalesce("far", "to")).alias("component"), "was"), tag)
        if moved.where("component <> was").isEmpty():
            return moved.select("node", "component")
        label = moved.select("node", "component")
