"""One row per key without moving the rows that stay alone.

``dedupe_by_key`` sends no row's content through an aggregate.  The rows are
written once with a number and a hash of their content; keys, order and number
alone decide, in fixed-width aggregates, which numbers lose, and an anti join on
the number drops those.  Usually few rows lose: then the list is broadcast at
run time and no content is shuffled at all, else it is shuffled once, by the
number, which no two rows share, so no group of copies meets in one task.

The survivor has the greatest order (NULL least); of those the greatest whole
row; equal rows are one.  Contents are compared only where rows that tie on the
order differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelens.session import scratch_path

ROW, HASH = "_row", "_row_hash"


def _stored(df: DataFrame, tag: str) -> DataFrame:
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_numbered(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """``df`` written to ``path`` with a number and a content hash a row, and read back."""
    clash = {ROW, HASH} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are this function's own")
    others = [F.col(c) for c in df.columns if c not in keys]
    out = df.withColumns({ROW: F.monotonically_increasing_id(), HASH: F.xxhash64(*others) if others else F.lit(0).cast("long")})
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def _on(keys: list[str], other: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, other)])


def losing_rows(rows: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """The numbers (``_row``) of the rows of ``rows`` (see ``write_numbered``) that another row of their key beats; written."""
    order_by, theirs = list(order_by or []), [f"_k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(o) for k, o in zip(keys, theirs)]
    order = F.struct(*order_by) if len(order_by) > 1 else order_by[0] if order_by else F.lit(0)
    narrow = rows.select(*renamed, order.alias("_o"), ROW, HASH)
    best = narrow.groupBy(*theirs).agg(F.count(F.lit(1)).alias("_c"), F.max("_o").alias("_top")).where("_c > 1")
    mine = [f"_m{i}" for i in range(len(keys))]
    best = best.select(*[F.col(o).alias(m) for o, m in zip(theirs, mine)], "_top")
    repeated = _stored(narrow.join(best, _on(theirs, mine)).select(*theirs, ROW, HASH, F.col("_o").eqNullSafe(F.col("_top")).alias("_top")), "repeated-keys")

    top = repeated.where("_top")
    first = top.groupBy(*theirs).agg(F.min(HASH).alias("_low"), F.max(HASH).alias("_high"), F.min(ROW).alias("_first"))
    winners = first.where("_low = _high").select(F.col("_first").alias("_won"))
    contested = first.where("_low <> _high").select(*[F.col(o).alias(m) for o, m in zip(theirs, mine)])
    others = [c for c in rows.columns if c not in (*keys, ROW, HASH)]
    if others and not contested.isEmpty():  # rows that tie and differ: their contents, and no others', are compared
        numbers = top.join(contested, _on(theirs, mine), "left_semi").select(F.col(ROW).alias("_n"))
        full = rows.join(numbers, F.col(ROW) == F.col("_n"), "left_semi")
        chosen = full.groupBy(*keys).agg(F.max(F.struct(*others, ROW)).alias("_best"))
        winners = winners.union(chosen.select(F.col(f"_best.{ROW}")))
    return _stored(repeated.select(ROW).join(winners, F.col(ROW) == F.col("_won"), "left_anti"), "losing-rows")


def without(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """``rows`` but for those whose number is in ``numbers``."""
    gone = numbers.select(F.col(ROW).alias("_gone"))
    return rows.join(gone, F.col(ROW) == F.col("_gone"), "left_anti")


def dedupe_by_key(df: DataFrame, keys: list[str] | str, order_by: list[Column] | None = None) -> DataFrame:
    """One row per key, the same under any partitioning; writes ``df`` once and runs narrow jobs before it returns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = write_numbered(df, keys, scratch_path(df.sparkSession, "numbered"))
    return without(rows, losing_rows(rows, keys, order_by)).select(*df.columns)
