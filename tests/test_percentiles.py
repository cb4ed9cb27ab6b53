"""Percentiles by counted ranges equal sorting, at any number of distinct values and under skew."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgelens.operators.percentiles import exact_percentiles

AT = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def _brute(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    out = {}
    for g, vs in groups.items():
        vs.sort()
        found = []
        for f in AT.values():
            at = f * (len(vs) - 1)
            low, high = vs[math.floor(at)], vs[math.ceil(at)]
            found.append(low + (high - low) * (at - math.floor(at)))
        out[g] = (len(vs), sum(vs), *found)
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_matches_sorting(spark, partitions):
    rng = random.Random(partitions)
    rows = [(g, rng.choice([None, rng.randrange(-50, 50) / 4])) for g in ("a", "b", None) for _ in range(300)]
    rows += [("hot", 2.5)] * 2000 + [("hot", 1.0)] + [("one", 7.0)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(partitions)
    got = {r.k: tuple(r)[1:] for r in exact_percentiles(df, "k", "v", AT).collect()}
    want = _brute(rows)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_ten_million_distinct_values_in_one_group(spark):
    n = 10_000_000
    df = spark.range(0, n, 1, 8).select(F.lit("x").alias("k"), (F.col("id") * 7919 % n / 4).alias("v"))
    r = exact_percentiles(df, "k", "v", AT).first()
    want = [f * (n - 1) / 4 for f in AT.values()]
    assert r.n == n and np.allclose([r[c] for c in AT], want, rtol=0, atol=1e-6)


def test_no_rows_and_bad_arguments(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert exact_percentiles(none, "k", "v", AT).count() == 0
    with pytest.raises(ValueError):
        exact_percentiles(none, "k", "v", {"x": 1.5})
    with pytest.raises(ValueError):
        exact_percentiles(none, "k", "v", {"n": 0.5})
