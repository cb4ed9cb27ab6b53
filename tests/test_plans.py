"""Plan properties of every registered query (checked on the optimized
physical plan, before execution): no cartesian products or nested-loop
joins, Python only where the scorer runs, and pruned, pushed-down scans."""

import re

import pytest

import __spark_entry__ as E
from lodgelens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
# Queries whose work is Python by design (the scorer runs in Python workers).
PYTHON_OK = {"score_batches", "score_batches_capped", "lexicon_score", "write_scored", "run_day"}
NAMES = sorted(QUERIES)  # the text-preparation queries are tested in tests/llm


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    python_nodes = re.findall(r"(BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas)", plan)
    if name not in PYTHON_OK:
        assert not python_nodes, f"{name}: unexpected Python in plan {python_nodes}"


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["supply_mix"](spark, SF))
    assert "ReadSchema: struct<p_type:string,p_retailprice:double>" in plan


def test_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["build_dim_date"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate)]" in plan


def test_fact_is_reduced_before_the_listing_join(spark):
    plan = _plan(E.queries()["sentiment_by_city"](spark, SF))
    # partial aggregate on the fact scan, below any join
    first_join = min(plan.find(j) for j in ("SortMergeJoin", "BroadcastHashJoin") if j in plan)
    assert plan.find("partial_count", first_join) > first_join


def test_dedupe_moves_no_content(spark):
    """Narrow fixed-width aggregates decide; contents meet the losers' numbers only."""
    from pyspark.sql import functions as F

    from lodgelens.operators import dedupe as D
    from lodgelens.session import scratch_path
    df = spark.range(1000).selectExpr("cast(id % 900 as string) k", "id as o", "repeat('text ', 20) as text")
    rows = D.write_numbered(df, ["k"], scratch_path(spark, "numbered"))
    first = rows.select("k", "o", D.ROW, D.HASH).groupBy("k").agg(F.count(F.lit(1)), F.max("o"))
    assert "HashAggregate" in _plan(first) and "SortAggregate" not in _plan(first)
    lost = D.losing_rows(rows, ["k"], [F.col("o")])
    plan = _plan(D.without(rows, lost))
    assert "Window" not in plan
    assert D.without(rows, lost).count() == 900


def test_curation_shuffles_texts_once_at_most(spark, tmp_root):
    """With broadcasts off, one exchange of the fact stage's plan carries the comments."""
    from pyspark.sql import functions as F

    from lodgelens.operators import curate as C
    from lodgelens.operators import dedupe as D
    from lodgelens.session import scratch_path
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = spark.range(500).selectExpr("cast(id % 450 as string) review_id", "cast(id % 50 as string) listing_id", "'2024-09-01' date", "'some text' comments")
        rows = D.write_numbered(C.parse_reviews(raw), ["review_id"], scratch_path(spark, "numbered"))
        dim = spark.range(40).selectExpr("cast(id as string) listing_id")
        losers = D.losing_rows(rows, ["review_id"], [F.col("review_date")])
        facts = C.fact_stage(D.without(rows, C.unwanted_reviews(rows, losers, dim)))
        lines = _plan(facts).split("\n")
        moved = [i for i, x in enumerate(lines) if "Exchange" in x and "comments" in "".join(lines[i + 1:i + 4])]
        assert len(moved) == 1  # the join with the unwanted rows' numbers
        assert facts.count() == 360
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
