"""Sampling and de-duplication give the same rows under any partitioning."""

from pyspark.sql import functions as F

from lodgelens.operators import curate as C
from lodgelens.operators import sampling as SM


def _ids(df, col="k"):
    return sorted(r[col] for r in df.collect())


def test_sample_fraction_layout_free(spark):
    base = spark.range(0, 5000).select(F.col("id").cast("string").alias("k"))
    a = _ids(SM.sample_fraction(base.repartition(1), 0.1, 42, "k"))
    b = _ids(SM.sample_fraction(base.repartition(7), 0.1, 42, "k"))
    assert a == b and 350 < len(a) < 650


def test_sample_fraction_seed_changes_rows(spark):
    base = spark.range(0, 2000).select(F.col("id").cast("string").alias("k"))
    assert _ids(SM.sample_fraction(base, 0.2, 1, "k")) != _ids(SM.sample_fraction(base, 0.2, 2, "k"))


def test_sample_off(spark):
    base = spark.range(0, 10).select(F.col("id").alias("k"))
    assert SM.sample_fraction(base, 0.0, 1, "k").count() == 10
    assert SM.sample_cap(base, 0, 1, "k").count() == 10


def test_sample_cap_matches_brute_force(spark):
    import hashlib
    base = spark.range(0, 3000).select(F.col("id").cast("string").alias("k"))
    got = _ids(SM.sample_cap(base.repartition(5), 25, 7, "k"))

    def u(k):
        return int(hashlib.md5(f"7:{k}".encode()).hexdigest()[:13], 16) / 16 ** 13
    want = sorted(sorted((str(i) for i in range(3000)), key=lambda k: (u(k), k))[:25])
    assert got == want


def test_dedupe_stable_under_shuffle(spark):
    rows = [(k % 37, k, f"v{k % 5}") for k in range(2000)]
    df = spark.createDataFrame(rows, "key int, seq int, val string")
    a = C.dedupe_by_key(df.repartition(1), "key", order_by=[F.col("seq")]).orderBy("key").collect()
    b = C.dedupe_by_key(df.repartition(9, "val"), "key", order_by=[F.col("seq")]).orderBy("key").collect()
    assert a == b and len(a) == 37
    # the survivor is the latest row of each key
    assert all(r["seq"] == max(k for k in range(2000) if k % 37 == r["key"]) for r in a)


def test_dedupe_without_order_is_deterministic(spark):
    rows = [(1, "b"), (1, "a"), (2, "z"), (2, "z")]
    df = spark.createDataFrame(rows, "key int, val string")
    out = C.dedupe_by_key(df, "key").orderBy("key").collect()
    assert [(r.key, r.val) for r in out] == [(1, "b"), (2, "z")]


def test_sample_cap_is_the_same_over_any_layout_and_keeps_null_keys(spark):
    base = spark.range(0, 20000).select(F.col("id").cast("string").alias("k"))
    assert _ids(SM.sample_cap(base.repartition(64), 150, 3, "k")) == _ids(SM.sample_cap(base.coalesce(1), 150, 3, "k"))
    few = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    for parts in (1, 3):
        assert {r.k for r in SM.sample_cap(few.repartition(parts), 3, 3, "k").collect()} == {None, "a", "b"}


def test_nth_smallest_matches_sorting(spark):
    import random
    rng = random.Random(1)
    for bits in (20, 52, 63):
        rows = [rng.randrange(1 << bits) for _ in range(500)] + [5] * 40 + [(1 << bits) - 1] * 3
        df = spark.createDataFrame([(x,) for x in rows], "x long").repartition(4)
        ordered = sorted(rows)
        for n in (1, 3, 30, 250, len(rows)):
            value = ordered[n - 1]
            assert SM.nth_smallest(df, F.col("x"), n, bits) == (value, sum(x < value for x in rows), rows.count(value))
        assert SM.nth_smallest(df, F.col("x"), len(rows) + 1, bits) is None


def test_sample_cap_of_a_million_is_a_filter(spark):
    """No sort, no limit and no single task: the n rows come out of the partitions that hold them."""
    base = spark.range(0, 3_000_000, 1, 8).select(F.col("id").cast("string").alias("k"))
    got = SM.sample_cap(base, 1_000_000, 5, "k")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Sort", "Limit", "TakeOrdered", "Exchange"))
    u = SM.hash_uniform("k", 5)
    assert got.count() == 1_000_000
    assert got.agg(F.max(u)).first()[0] < base.join(got, "k", "left_anti").agg(F.min(u)).first()[0]


def test_sample_cap_splits_ties_by_the_row(spark):
    """A key with most rows: distinct rows of it are the same over any layout, equal ones are taken by number."""
    rows = [("hot", i) for i in range(500)] + [("hot", 7)] * 800 + [(f"k{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, v int")
    cut = lambda parts, n: sorted(tuple(r) for r in SM.sample_cap(df.repartition(parts), n, 3, "k").collect())
    for n in (1, 30, 60, 400, 900, 1349, 1350, 5000):
        one, many = cut(1, n), cut(9, n)
        assert one == many and len(one) == min(n, len(rows))


def test_sample_cap_with_maps_and_no_rows(spark):
    df = spark.range(40).selectExpr("'same' as k", "map('a', id % 4) as m")
    assert SM.sample_cap(df, 7, 1, "k").count() == 7
    assert SM.sample_cap(df.where("false"), 7, 1, "k").count() == 0
