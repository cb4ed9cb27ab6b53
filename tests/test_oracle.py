"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from lodgelens.plans.catalog import QUERIES  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)  # the text-preparation queries are tested in tests/llm


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(E.oracle_sql()))
    assert missing == [], missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert res["status"] == "ok", res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["band", "listing_id", "n_reviews", "positive_rate"]
    assert df.count() >= 0
