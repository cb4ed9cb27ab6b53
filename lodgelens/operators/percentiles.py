"""Exact percentiles (PERCENTILE_CONT) per group without a buffer per group.

Equal values are counted first, map-side.  The counted values are dealt by
ranges of (group, value), so a group of any number of distinct values spans as
many ranges as it needs, and written.  The rows of a range before a value's
range, summed per group over the ranges, say which range holds a wanted rank;
only that range's counts are then run through, to the value at the rank.  No
task sees more than a range, and what is joined back is one row per group and
wanted rank.

NULL values are left out, as in PERCENTILE_CONT; NULL is a group like others.
A group whose values are all NULL, or an empty table, has no row.  NaN is
greater than any number, -0.0 equals 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelens.session import scratch_path


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """g, v, n: how often each known value occurs in each group."""
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    return rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))


def by_ranges(counts: DataFrame) -> DataFrame:
    """The counted values with the number of the range of (g, v) that they fall in, written."""
    path = scratch_path(counts.sparkSession, "value-ranges")
    order = [F.asc_nulls_first("g"), F.asc("v")]
    counts.repartitionByRange(*order).withColumn("range", F.spark_partition_id()).write.parquet(path)
    return counts.sparkSession.read.parquet(path)


def exact_percentiles(df: DataFrame, group: str, value: str, fractions: dict[str, float]) -> DataFrame:
    """``group``, n (known values), total (their sum) and one column per name of ``fractions``.

    ``fractions`` maps column names to shares in [0, 1]; between two ranks the
    value is interpolated.
    """
    if not fractions or not all(0 <= f <= 1 for f in fractions.values()):
        raise ValueError("fractions lie in [0, 1]")
    taken = {"n", "total", *fractions}
    if group in taken or len(taken) < len(fractions) + 2:
        raise ValueError("output columns clash")
    ranged = by_ranges(value_counts(df, group, value))

    # rows of each group in each range, and before it
    sizes = ranged.groupBy("g", "range").agg(F.sum("n").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("g", "range", "rows", F.coalesce(before, F.lit(0)).alias("before"))
    groups = ranged.groupBy("g").agg(F.sum("n").alias("n"), F.sum(F.col("v") * F.col("n")).alias("total"))

    # the two ranks (from 0) that each fraction lies between
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(float(f)) * (F.col("n") - 1)).alias("at")) for name, f in fractions.items()])
    ranks = groups.select("g", F.explode(wanted).alias("w")).select(
        F.col("g").alias("rg"), "w.name", "w.at", F.explode(F.array(F.floor("w.at"), F.ceil("w.at"))).alias("rank")).distinct()
    placed = ranks.join(sizes, _same("rg", "g") & (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows")))
    placed = placed.select("rg", F.col("range").alias("rrange"), "before", "name", "at", "rank")

    # running counts in the ranges that hold a rank
    hit = placed.select("rg", "rrange", "before").distinct()
    within = Window.partitionBy("g", "range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = (ranged.join(hit, _same("g", "rg") & (F.col("range") == F.col("rrange"))).select("g", "range", "v", "n", "before")
           .withColumn("upto", F.col("before") + F.sum("n").over(within)).withColumn("from", F.col("upto") - F.col("n"))
           .select(F.col("g").alias("vg"), F.col("range").alias("vrange"), "v", "from", "upto"))
    found = placed.join(run, _same("rg", "vg") & (F.col("rrange") == F.col("vrange")) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("upto")))
    low, high = F.min_by("v", "rank"), F.max_by("v", "rank")
    value_at = found.groupBy("rg", "name").agg((low + (high - low) * (F.first("at") - F.floor(F.first("at")))).alias("x"))
    wide = value_at.groupBy("rg").agg(*[F.max(F.when(F.col("name") == name, F.col("x"))).alias(name) for name in fractions])
    return groups.join(wide, _same("g", "rg")).select(F.col("g").alias(group), "n", "total", *fractions)
