"""De-duplication by narrow columns and key bitmaps, against brute force and the plain joins."""

import random

import pytest
from pyspark.sql import functions as F

from lodgelens.operators import adhoc as A
from lodgelens.operators import bitmap as B
from lodgelens.operators import curate as C
from lodgelens.operators import dedupe as D


def _rank(x):
    return (x is not None, x if x is not None else 0)


def _rows(n, seed):
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice(xs)
    return [(pick("a", "b", "c", None, f"k{i % 60}"), pick(1, 2, 3, None), pick("x", "y", None), pick(0.5, 1.5)) for i in range(n)] + [("copies", 9, "same", 0.5)] * 400


@pytest.mark.parametrize("partitions", [1, 9])
@pytest.mark.parametrize("orders", [0, 1, 2])
def test_survivors_match_brute_force(spark, partitions, orders):
    rows = _rows(500, 3)
    df = spark.createDataFrame(rows, "k string, o int, t string, v double").repartition(partitions)
    by = [F.col("o"), F.col("v")][:orders]
    got = sorted(map(str, D.dedupe_by_key(df, "k", by).collect()))
    assert got == sorted(map(str, C.dedupe_in_plan(df, "k", by).collect()))
    best = {}
    for r in rows:
        rank = [_rank(r[1]), _rank(r[3])][:orders] + [_rank(x) for x in r[1:]]
        if r[0] not in best or rank > best[r[0]][0]:
            best[r[0]] = rank, r
    assert got == sorted(f"Row(k={r[0]!r}, o={r[1]!r}, t={r[2]!r}, v={r[3]!r})" for _, r in best.values())


def test_several_keys_keys_alone_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (1, 2, "c"), (1, 2, "c")], "x int, y int, t string")
    assert sorted(r.t for r in D.dedupe_by_key(df, ["x", "y"]).collect()) == ["b", "c"]
    assert D.dedupe_by_key(df.select("x", "y"), ["x", "y"]).count() == 2
    assert D.dedupe_by_key(df.where("false"), "x").count() == 0
    with pytest.raises(ValueError):
        D.dedupe_by_key(df.withColumnRenamed("t", "_row"), "x")


def test_a_third_of_all_rows_are_copies_of_one(spark):
    df = spark.range(30000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id as string) end as k", "case when id % 3 = 0 then 'same' else 'own' end as t")
    assert D.dedupe_by_key(df.repartition(8), "k").count() == 20001


@pytest.mark.parametrize("n", [0, 1, 3000, 40_000])
def test_bitmap_semi_join_equals_the_plain_one(spark, n):
    keys = spark.range(n).selectExpr("cast(id * 3 as string) as k")
    df = spark.range(9000).selectExpr("cast(id as string) as k", "id").union(spark.createDataFrame([(None, 1)], "k string, id long"))
    assert sorted(r.id for r in B.semi_join(df, keys, "k").collect()) == sorted(r.id for r in df.join(keys, "k", "left_semi").collect())


def test_bitmap_drops_most_strangers_and_keeps_all_partners(spark):
    keys = spark.range(5000).selectExpr("cast(id as string) as k").union(spark.createDataFrame([(None,)], "k string"))
    bitmap = B.key_bitmap(keys, "k")
    assert bitmap[1] == 1 << 17
    kept = B.may_hold(spark.range(105_000).selectExpr("cast(id as string) as k", "id"), "k", bitmap)
    assert kept.where("id < 5000").count() == 5000
    assert kept.where("id >= 5000").count() < 100_000 / 16


def test_bitmap_size_is_bounded():
    assert B.bitmap_bits(0) == 1 << 15 and B.bitmap_bits(10 ** 12) == 1 << 26
    assert B.bitmap_bits(4096) == 1 << 16 and B.bitmap_bits(4097) == 1 << 17


def test_known_listings_with_a_hot_stranger(spark):
    reviews = spark.range(9000).selectExpr("cast(id as string) review_id", "case when id % 3 = 0 then 'stranger' else cast(id % 700 as string) end listing_id")
    listings = spark.range(600).selectExpr("cast(id as string) listing_id")
    want = sum(1 for i in range(9000) if i % 3 and i % 700 < 600)
    assert A.semi_join_known_listings(reviews, listings).count() == want
