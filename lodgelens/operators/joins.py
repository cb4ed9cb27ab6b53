"""Skew-safe equi-join of a many-side to a unique-key side by salting hot keys.

AQE's skew-join splitting handles hot partitions when it is enabled and its
thresholds are met.  ``salted_join`` does the same explicitly, for sessions
where that is not the case:

1. count rows per key on the many side (map-side partial aggregation);
2. the hot keys are those holding at least ``1 / max_hot_keys`` of all rows,
   so there are at most ``max_hot_keys`` of them: a proven bound, which is
   what lets that small list be broadcast;
3. rows of hot keys get a deterministic salt in ``[0, buckets)`` from a hash
   of the row, other rows salt 0;
4. the unique side is replicated once per salt for hot keys only (an
   ``explode``, no cross join), and the join runs on ``(key, salt)``.

Every many-side row meets exactly the one matching row of the unique side,
so the result equals the plain join, while a hot key's rows are spread over
``buckets`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def hot_keys(many: DataFrame, key: str, max_hot_keys: int = 1000) -> DataFrame:
    """Keys holding at least 1/max_hot_keys of the rows (at most max_hot_keys keys)."""
    total = many.count()  # one scalar to the driver
    per_key = many.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.where(F.col("_n") * F.lit(max_hot_keys) >= F.lit(total)).select(key)


def salted_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner",
                buckets: int = 32, max_hot_keys: int = 1000) -> DataFrame:
    """``many.join(one, key, how)`` with hot keys spread over ``buckets`` tasks.

    ``one`` must be unique on ``key``; ``how`` is ``inner``, ``left`` or
    ``left_semi`` (the many side on the left).
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"salted_join supports inner, left and left_semi, not {how}")
    hot = F.broadcast(hot_keys(many, key, max_hot_keys).withColumn("_hot", F.lit(True)))
    row_hash = F.xxhash64(*[F.col(c) for c in many.columns])
    m = (many.join(hot, key, "left")
         .withColumn(SALT, F.when(F.col("_hot"), F.pmod(row_hash, F.lit(buckets))).otherwise(F.lit(0)))
         .drop("_hot"))
    o = (one.join(hot, key, "left")
         .withColumn(SALT, F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1)))
                                     .otherwise(F.array(F.lit(0)))))
         .drop("_hot"))
    return m.join(o, [key, SALT], how).drop(SALT)
