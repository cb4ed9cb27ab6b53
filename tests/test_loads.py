"""Loads by files: only new or changed files are read, and bad ones are refused and read again."""

import os

import pytest

from lodgelens.sources import loads as L
from lodgelens.sources import raw as R


def _land(root, name, text):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w", encoding="utf-8") as f:
        f.write(text)


def _load(spark, drop, ledger, **limits):
    got = []

    def place(rows):
        got.extend((r.id, os.path.basename(r[L.FILE])) for r in rows.collect())
        return len(got)
    report = L.load(spark, drop, ledger, place, limits)
    return sorted(got), report


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    drop, ledger = str(tmp_path / "drop"), str(tmp_path / "ledger")
    assert _load(spark, drop, ledger) == ([], None)  # no drop yet
    _land(drop, "a.csv", 'id,text\n1,"two\nlines"\n2,x\n')
    _land(drop, "b.csv", "id,text\n3,y\n")
    got, report = _load(spark, drop, ledger)
    assert got == [("1", "a.csv"), ("2", "a.csv"), ("3", "b.csv")]
    assert sorted((os.path.basename(r.path), r.rows, r.malformed) for r in report.collect()) == [("a.csv", 2, 0), ("b.csv", 1, 0)]
    assert _load(spark, drop, ledger) == ([], None)
    _land(os.path.join(drop, "later"), "c.csv", "id,text\n4,z\n")
    _land(drop, "b.csv", "id,text\n3,y\n5,more\n")
    got, _ = _load(spark, drop, ledger)
    assert got == [("3", "b.csv"), ("4", "c.csv"), ("5", "b.csv")]
    assert _load(spark, drop, ledger) == ([], None)


def test_bad_files_are_refused_and_stay_new(spark, tmp_path):
    drop, ledger = str(tmp_path / "drop"), str(tmp_path / "ledger")
    _land(drop, "good.csv", "id,text\n" + "".join(f"{i},x\n" for i in range(200)))
    _land(drop, "short.csv", "id,text\n1,a\n2\n3,b,c\n")
    _land(drop, "header.csv", "id,text\n")
    with pytest.raises(L.LoadRefused) as e:
        _load(spark, drop, ledger, most_bytes=500)
    assert [(f["check"], os.path.basename(f["path"])) for f in e.value.findings] == [
        ("file_bytes", "good.csv"), ("malformed_share", "short.csv"), ("no_rows", "header.csv")]
    os.remove(os.path.join(drop, "header.csv"))
    _land(drop, "short.csv", "id,text\n1,a\n")
    got, _ = _load(spark, drop, ledger)
    assert len(got) == 201


def test_rows_lost_on_the_way_are_found(spark, tmp_path):
    drop, ledger = str(tmp_path / "drop"), str(tmp_path / "ledger")
    _land(drop, "a.csv", "id,text\n1,x\n2,y\n")
    with pytest.raises(L.LoadRefused) as e:
        L.load(spark, drop, ledger, lambda rows: rows.limit(1).count())
    assert e.value.findings == [{"check": "rows_loaded", "path": None, "value": 1.0}]
    assert L.seen_files(spark, ledger).count() == 0


def test_listing_reads_no_contents(spark, tmp_path):
    _land(str(tmp_path), "a.csv", "id\n1\n")
    plan = L.files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_scan_of_files_names_them(spark, tmp_path):
    _land(str(tmp_path), "a.csv", " ID ,text\n1,x\n")
    df = R.scan_csv_raw(spark, [str(tmp_path / "a.csv")], file_col="src")
    assert df.columns == ["id", "text", R.CORRUPT_COL, "src"] and df.first().src.endswith("a.csv")
