"""Exact top-k search by columnar branch-and-bound.

Vectors are turned into integers and laid out vertically, one row per
dimension.  For each query, inner products are accumulated a block of
dimensions at a time.  What the remaining dimensions can still add is at most
the product of the two vectors' remaining masses (Euclidean norms), so a
candidate whose partial score plus that bound is below the k-th best score so
far is dropped, and the survivors are compacted before the next block.

Queries go in blocks of about ``QUERY_BLOCK`` at most, and about ``BLOCK_BYTES``
in all; each block is sent to all tasks and every vector is read once per block.
A task returns its own k best per query, and one more pass ranks those.

A null vector, or one with a null or non-finite component, takes no part.
Vectors of different lengths are never compared.  Rows that repeat a vec_id
are each a candidate, but never for a query with their own id; the query rows
of one id share one ranking, in which equal query rows count once.  Scores are
exact at every magnitude: products are summed in doubles while they stay under
2^53, in 64-bit integers under 2^62, and in Python's integers beyond; bounds are
widened by what rounding can take.  A score among a task's k best that no long
holds, or a component that 1024 takes beyond a double, is an OverflowError.
Ties go to the smaller vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

QUERY_BLOCK, BLOCK_BYTES = 4096, 32 << 20
DIMENSIONS = 16
EXACT_FLOAT, EXACT_LONG = 2.0 ** 53, 2.0 ** 62
#: Relative errors that a bound allows for: of the masses, and of a score as a double.
MASS_ERROR, SCORE_ERROR = 1e-9, 1e-15


def whole(vectors: list, scale: int) -> np.ndarray:
    """floor(scale * x): whole numbers, which doubles hold exactly."""
    with np.errstate(over="ignore"):
        out = np.floor(np.array(vectors, np.float64) * scale)
    if not np.isfinite(out).all():
        raise OverflowError("a scaled component is beyond a double")
    return out


def exact(values: np.ndarray, bound: float) -> np.ndarray:
    """Whole numbers as a type in which sums up to ``bound`` are exact."""
    if bound < EXACT_FLOAT:
        return values
    if bound < EXACT_LONG:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel().tolist()], object).reshape(values.shape)


def masses(ints: np.ndarray, step: int) -> np.ndarray:
    """masses[b]: norm of what is left from dimension ``b * step`` on (columns are vectors)."""
    with np.errstate(over="ignore"):
        squares = np.cumsum((ints ** 2)[::-1], 0)[::-1]
    left = np.sqrt(squares[::step])
    return np.concatenate([left, np.zeros((1, ints.shape[1]))])


def search(q: np.ndarray, qmass: np.ndarray, columns: np.ndarray, vmass: np.ndarray,
           at: np.ndarray, partial: np.ndarray, floor: float, k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, score) of every candidate that may be among the k best at or over ``floor``."""
    b, d = 1, len(q)
    while True:
        if b * step >= d:
            return at, partial
        so_far = partial.astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            rest = qmass[b] * vmass[b][at] * (1 + MASS_ERROR) + 1 + np.abs(so_far) * SCORE_ERROR
        rest[np.isnan(rest)] = np.inf
        if len(partial) > k:  # k candidates are certain to reach this
            floor = max(floor, np.partition(so_far - rest, -k)[-k])
        live = so_far + rest >= floor
        at, partial = at[live], partial[live]
        if not len(at):
            return at, partial
        part = slice(b * step, (b + 1) * step)
        partial = partial + q[part] @ columns[part][:, at]
        b += 1


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best, scores as longs."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
        if any(not -2 ** 63 <= x < 2 ** 63 for x in scores[order]):
            raise OverflowError("a score is beyond a long")
    else:
        order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order].astype(np.int64)


def _pass(vectors: DataFrame, queries: list, k: int, scale: int, step: int) -> DataFrame:
    spark = vectors.sparkSession
    by_length: dict[int, list] = {}
    for r in queries:
        by_length.setdefault(len(r[1]), []).append((r[0], r[1]))
    sent = spark.sparkContext.broadcast({
        d: (np.array([r[0] for r in rows], np.int64), whole([r[1] for r in rows], scale)) for d, rows in by_length.items() if d})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        qmasses = {d: masses(q.T, step) for d, (_, q) in sent.value.items()}
        for batch in batches:
            ids_all = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            for d, (qids, q) in sent.value.items():
                rows = np.flatnonzero(lengths == d)
                if not len(rows):
                    continue
                ids = ids_all[rows]
                flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d)
                ints = np.ascontiguousarray(whole(flat, scale).T)
                bound = float(np.abs(ints).max(initial=0)) * float(np.abs(q).max(initial=0)) * d
                columns, vmass, qs = exact(ints, bound), masses(ints, step), exact(q, bound)
                for first in range(0, len(q), 64):
                    opening = qs[first:first + 64, :step] @ columns[:step]
                    for i in range(first, min(first + 64, len(q))):
                        at = np.flatnonzero(ids != qids[i])
                        had = top.get((d, i))
                        floor = float(had[1][-1]) if had is not None and len(had[1]) == k else -np.inf
                        floor -= abs(floor) * SCORE_ERROR if had is not None and len(had[1]) == k else 0
                        got, score = search(qs[i], qmasses[d][:, i], columns, vmass, at, opening[i - first][at], floor, k, step)
                        new = ids[got], score if score.dtype == object else score.astype(np.int64)
                        if had is not None:
                            new = np.concatenate([had[0], new[0]]), np.concatenate([had[1], new[1]])
                        top[d, i] = best(*new, k)
        for (d, i), (ids, scores) in top.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), sent.value[d][0][i])), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")


def exact_top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024,
                step: int = DIMENSIONS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for ``vectors`` and ``queries`` (vec_id, embedding)."""
    fit = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    vectors, queries = (x.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(fit) for x in (vectors, queries))
    queries = queries.dropDuplicates()
    count, bytes_ = queries.agg(F.count("*"), F.coalesce(F.sum(8 * F.size("embedding")), F.lit(0))).first()
    blocks = max(1, -(-count // query_block), -(-bytes_ // BLOCK_BYTES))
    block = queries.withColumn("b", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)))
    found = None
    for b in range(blocks):  # a bounded block of queries at a time, against all vectors
        part = _pass(vectors, block.where(F.col("b") == b).select("vec_id", "embedding").collect(), k, scale, step)
        part = C.stored(part, "top-k") if blocks > 1 else part
        found = part if found is None else found.union(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op4_branch_bound_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every vector whose id is divisible by 100, against all ``embeddings``."""
    v = C.table(spark, sf_dir, "embeddings")
    return exact_top_k(spark, v, v.where("vec_id % 100 = 0"))
