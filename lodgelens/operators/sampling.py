"""Deterministic, layout-independent sampling.

``df.sample(frac, seed)`` and ``orderBy(rand(seed))`` depend on how rows are
split into partitions, so a retry or a different cluster size can pick other
rows.  Here every row gets a uniform number from a hash of ``(seed, key)``;
the fraction is a filter on that number (no shuffle, pushed into the scan
stage), and the cap is a filter too: the number of the n-th row is found first,
by counting rows in ever finer ranges of the number, and all rows up to it pass.
No task gathers the n rows, however many they are.  The same rows come back
under any partitioning, and a lost executor recomputes exactly the same sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

# md5 is available in both Spark and DuckDB, so the sample can be checked
# row for row against SQL.  13 hex digits = 52 bits -> an exact double in [0, 1).
_HEX_DIGITS = 13
_SCALE = float(16 ** _HEX_DIGITS)


#: Bits of a number that one counting pass tells apart.
PASS_BITS = 16


def _digits(key: Column, seed: int) -> Column:
    """A uniform whole number below 2^52 determined by ``(seed, key)`` only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("long")


def hash_uniform(key: Column | str, seed: int) -> Column:
    """A uniform double in [0, 1) determined by ``(seed, key)`` only."""
    return _digits(F.col(key) if isinstance(key, str) else key, seed).cast("double") / F.lit(_SCALE)


def sample_fraction(df: DataFrame, fraction: float, seed: int, key: str) -> DataFrame:
    """Bernoulli sample keeping about ``fraction`` of rows; 0 (or >= 1) = off."""
    if not fraction or fraction <= 0 or fraction >= 1:
        return df
    return df.where(hash_uniform(key, seed) < F.lit(float(fraction)))


def nth_smallest(df: DataFrame, number: Column, n: int, bits: int) -> tuple[int, int, int] | None:
    """The n-th smallest (from 1) of ``number``, whole and in 0 .. 2^bits - 1: (value, rows below it, rows equal to it).

    None if there are fewer rows.  Each pass counts the rows of 2^16 equal
    ranges, one row a range and task being shuffled, and the next one looks
    into the range that holds the n-th; at most bits / 16 passes, rounded up.
    """
    low, width, below = 0, bits, 0
    numbers = df.select(number.cast("long").alias("x"))
    while True:
        step = max(width - PASS_BITS, 0)
        inside = numbers.where((F.col("x") >= low) & (F.col("x") <= low + ((1 << width) - 1))) if width < bits else numbers
        counts = inside.groupBy(F.shiftright(F.col("x") - low, step).alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
        upto = below
        for r in sorted(counts.collect()):  # 2^16 rows at most
            if upto + r.rows >= n:
                break
            upto += r.rows
        else:
            return None
        low, width, below = low + (r.bin << step), step, upto
        if not step:
            return low, below, r.rows


def sample_cap(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """At most ``n`` rows, those with the smallest seeded numbers; 0 = off.

    One way at every size: the n-th number is found by counting (a few jobs),
    the rest is a filter.  Where rows tie on it (equal keys, mostly), the
    smaller hash of the whole row goes first, found the same way; rows that
    tie on that too are equal, and as many as are missing pass, taken by their
    place within their partition.  A NULL key draws the number of the empty
    key, and the sample is not in any order.
    """
    if not n or n <= 0:
        return df
    draw = _digits(F.coalesce(F.col(key).cast("string"), F.lit("")), seed)
    found = nth_smallest(df, draw, n, 4 * _HEX_DIGITS)
    if found is None:
        return df
    value, below, equal = found
    if below + equal == n:
        return df.where(draw <= value)
    # maps can't be hashed; their entries can
    row = F.shiftrightunsigned(F.xxhash64(*[F.map_entries(f.name) if isinstance(f.dataType, MapType) else F.col(f.name) for f in df.schema]), 1)
    tied = df.where(draw == value)
    last, before, same = nth_smallest(tied, row, n - below, 63)
    missing = n - below - before
    if same == missing:
        return df.where((draw < value) | ((draw == value) & (row <= last)))
    some = _first_places(tied.where(row == last), missing)
    return df.where((draw < value) | ((draw == value) & (row < last))).unionByName(some)


def _first_places(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` of the (equal) rows: whole partitions in order, and the first rows of one."""
    place = F.monotonically_increasing_id()
    placed = df.withColumn("_place", place)
    sizes = sorted(placed.groupBy(F.shiftright("_place", 33).alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.max("_place").alias("last")).collect())
    end = -1  # one row a partition reaches the driver
    for r in sizes:
        if r.rows >= n:
            # rows of a partition are numbered without gaps
            return placed.where(F.col("_place") <= (r.last - r.rows + n)).drop("_place")
        n, end = n - r.rows, r.last
    return placed.where(F.col("_place") <= end).drop("_place")
