"""Versioned publication: all tables together or none, and days replaced only when written whole."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from lodgelens.sources import curated as CU
from lodgelens.sources import storage
from lodgelens.sources import warehouse as W


def _dates(spark, *keys):
    return spark.createDataFrame([(k, k // 10000, 9, 1, 1, False) for k in keys],
                                 "date_key int, yyyy int, mm int, dd int, dow int, is_weekend boolean")


def _failing(df):
    """The same rows, but the last partition's task dies after others have written theirs."""
    return df.repartition(3).withColumn("yyyy", F.when(F.spark_partition_id() == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("yyyy")))


def test_publish_read_and_go_back(spark, tmp_root):
    with pytest.raises(W.NoVersion):
        W.read(spark, tmp_root)
    one = W.publish(spark, {"dim_date": _dates(spark, 20240901), "other": spark.range(3)}, tmp_root, "2024-09-01")
    two = W.publish(spark, {"dim_date": _dates(spark, 20240902, 20240903), "other": spark.range(0)}, tmp_root, "2024-09-02")
    assert (one.number, two.number, two.ds, two.rows) == (1, 2, "2024-09-02", {"dim_date": 2, "other": 0})
    assert sorted(r.date_key for r in W.read(spark, tmp_root)["dim_date"].collect()) == [20240902, 20240903]
    old = W.read(spark, tmp_root, 1)
    assert [r.date_key for r in old["dim_date"].collect()] == [20240901] and old["other"].count() == 3
    with pytest.raises(W.NoVersion):
        W.resolve(spark, tmp_root, 9)


def test_a_publication_that_fails_half_way_changes_nothing(spark, tmp_root):
    W.publish(spark, {"dim_date": _dates(spark, 1, 2, 3), "other": spark.range(5)}, tmp_root, "2024-09-01")
    with pytest.raises(Exception, match="lost"):
        W.publish(spark, {"dim_date": _failing(_dates(spark, *range(100))), "other": spark.range(9)}, tmp_root, "2024-09-02")
    now = W.read(spark, tmp_root)
    assert W.versions(spark, tmp_root) == [1] and now["dim_date"].count() == 3 and now["other"].count() == 5
    # and what it left behind goes when versions expire
    assert len(os.listdir(os.path.join(tmp_root, "data"))) == 2
    assert W.expire(spark, tmp_root, 1) == []
    assert len(os.listdir(os.path.join(tmp_root, "data"))) == 1 and W.read(spark, tmp_root)["other"].count() == 5


def test_publications_at_once_get_numbers_of_their_own(spark, tmp_root):
    got = []
    threads = [threading.Thread(target=lambda k=k: got.append((W.publish(spark, {"t": spark.range(k)}, tmp_root, "2024-09-01").number, k))) for k in range(1, 6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(n for n, _ in got) == [1, 2, 3, 4, 5]
    assert all(W.read(spark, tmp_root, n)["t"].count() == k for n, k in got)


def test_expire_keeps_the_last(spark, tmp_root):
    for k in range(4):
        W.publish(spark, {"t": spark.range(k)}, tmp_root, "2024-09-01")
    assert W.expire(spark, tmp_root, 2) == [1, 2] and W.versions(spark, tmp_root) == [3, 4]
    assert W.read(spark, tmp_root, 3)["t"].count() == 2 and W.read(spark, tmp_root)["t"].count() == 3
    with pytest.raises(ValueError):
        W.expire(spark, tmp_root, 0)


def test_a_table_of_another_type_is_refused(spark, tmp_root):
    W.publish(spark, {"dim_date": spark.createDataFrame([("x",)], "date_key string")}, tmp_root, "2024-09-01")
    with pytest.raises(TypeError):
        W.read(spark, tmp_root)


def test_a_day_that_fails_half_way_keeps_the_old_one(spark, tmp_root):
    root = os.path.join(tmp_root, "t")
    CU.write_partition(_dates(spark, 7), root, "2024-09-01")
    CU.write_partition(_dates(spark, 8), root, "2024-09-02")
    with pytest.raises(Exception, match="lost"):
        CU.write_partition(_failing(_dates(spark, *range(100))), root, "2024-09-01")
    assert [r.date_key for r in CU.scan_curated_partition(spark, root, "2024-09-01").collect()] == [7]
    CU.write_partition(_dates(spark, 9), root, "2024-09-01")
    assert sorted((str(r.ds), r.date_key) for r in spark.read.parquet(root).collect()) == [("2024-09-01", 9), ("2024-09-02", 8)]


def test_a_day_left_aside_comes_back(spark, tmp_root, monkeypatch):
    """The driver dies after it moved the old day away and before the new one took its place."""
    root = os.path.join(tmp_root, "t")
    CU.write_partition(_dates(spark, 7), root, "2024-09-01")
    whole = storage.move
    monkeypatch.setattr(storage, "move", lambda s, a, b: whole(s, a, b) if "/old-" in b else (_ for _ in ()).throw(RuntimeError("driver gone")))
    with pytest.raises(RuntimeError, match="driver gone"):
        CU.write_partition(_dates(spark, 8), root, "2024-09-01")
    monkeypatch.undo()
    with pytest.raises(CU.EmptyStageError):
        CU.scan_curated_partition(spark, root, "2024-09-01")
    assert CU.restore_days(spark, root) == ["ds=2024-09-01"] and CU.restore_days(spark, root) == []
    assert [r.date_key for r in CU.scan_curated_partition(spark, root, "2024-09-01").collect()] == [7]
