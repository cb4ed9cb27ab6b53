"""Raw CSV scan, dynamic partition writes, partition resolution, snapshots."""

import datetime as dt
import os

import pytest

from lodgelens.sources import curated as CU
from lodgelens.sources import raw as R


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_scan_csv_raw_messy(spark, tmp_root):
    text = (' ID ,Comments,Extra\n'
            '1,"line one\nline two",x\n'
            '2,"she said ""wow""",y\n'
            '3,short\n'
            '4,too,many,fields\n')
    path = _write(os.path.join(tmp_root, "raw"), text)
    df = R.scan_csv_raw(spark, path)
    assert df.columns == ["id", "comments", "extra", R.CORRUPT_COL]
    rows = {r["id"]: r for r in df.collect()}
    assert rows["1"]["comments"] == "line one\nline two" and rows["1"][R.CORRUPT_COL] is None
    assert rows["2"]["comments"] == 'she said "wow"'
    assert rows["3"]["extra"] is None and rows["3"][R.CORRUPT_COL] is not None
    assert rows["4"]["extra"] == "many" and rows["4"][R.CORRUPT_COL] is not None


def test_normalize_columns_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A` int, ` a` int")
    with pytest.raises(ValueError):
        R.normalize_columns(df)


def test_standardize_keys(spark):
    df = spark.createDataFrame([(7, 3)], "id int, listing_id int")
    out = R.standardize_keys(df, "review_id", "listing_id")
    assert dict(out.dtypes) == {"review_id": "string", "listing_id": "string"}
    kept = R.standardize_keys(spark.createDataFrame([(1, 2)], "id int, listing_id int"), "listing_id")
    assert "id" in kept.columns and dict(kept.dtypes)["listing_id"] == "string"


def test_write_partition_keeps_other_days(spark, tmp_root):
    root = os.path.join(tmp_root, "t")
    day1 = spark.createDataFrame([(1,), (2,)], "x int")
    day2 = spark.createDataFrame([(3,)], "x int")
    CU.write_partition(day1, root, "2024-09-01")
    CU.write_partition(day2, root, "2024-09-02")
    CU.write_partition(spark.createDataFrame([(9,)], "x int"), root, "2024-09-01")
    got = sorted((str(r.ds), r.x) for r in spark.read.parquet(root).collect())
    assert got == [("2024-09-01", 9), ("2024-09-02", 3)]


def test_resolve_ds(spark, tmp_root):
    root = os.path.join(tmp_root, "stage")
    with pytest.raises(CU.EmptyStageError):
        CU.resolve_ds(spark, root, "2024-09-01")
    df = spark.createDataFrame([(1,)], "x int")
    CU.write_partition(df, root, "2024-08-31")
    CU.write_partition(df, root, "2024-09-02")
    assert CU.resolve_ds(spark, root, "2024-08-31") == dt.date(2024, 8, 31)
    assert CU.resolve_ds(spark, root, "2024-09-05") == dt.date(2024, 9, 2)
    assert CU.resolve_ds(spark, root) == dt.date(2024, 9, 2)


def test_scan_partition_is_pruned(spark, tmp_root):
    root = os.path.join(tmp_root, "p")
    CU.write_partition(spark.createDataFrame([(1,)], "x int"), root, "2024-09-01")
    CU.write_partition(spark.createDataFrame([(2,)], "x int"), root, "2024-09-02")
    df = CU.scan_curated_partition(spark, root, "2024-09-02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ds=2024-09-02" in plan and "ds=2024-09-01" not in plan  # only that day is listed
    assert [(r.x, str(r.ds)) for r in df.collect()] == [(2, "2024-09-02")]
    with pytest.raises(CU.EmptyStageError):
        CU.scan_curated_partition(spark, root, "2024-09-03")


def test_list_days(spark, tmp_root):
    root = os.path.join(tmp_root, "days")
    assert CU.list_days(spark, root) == []
    for d in ("2024-09-03", "2024-08-30"):
        CU.write_partition(spark.createDataFrame([(1,)], "x int"), root, d)
    assert CU.list_days(spark, root) == [dt.date(2024, 8, 30), dt.date(2024, 9, 3)]


def test_load_snapshot_conforms(spark, tmp_root):
    root = os.path.join(tmp_root, "f")
    df = spark.createDataFrame([("r1", "l1", 20240901, "hi", 1, "POSITIVE", 0.9, "extra")],
                               "review_id string, listing_id string, date_key int, comments string, "
                               "tokens_ct int, sentiment_label string, sentiment_score double, junk string")
    CU.write_partition(df, root, "2024-09-01")
    snap = CU.load_snapshot(spark, root, "fact_reviews", "2024-09-01")
    assert snap.columns == ["review_id", "listing_id", "date_key", "rating", "comments", "tokens_ct",
                            "sentiment_label", "sentiment_score"]
    row = snap.first()
    assert row["rating"] is None and row["sentiment_score"] == 0.9


def test_empty_guard(spark):
    assert CU.empty_guard(spark.range(0))
    assert not CU.empty_guard(spark.range(3))
