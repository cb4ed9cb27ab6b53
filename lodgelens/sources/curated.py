"""Curated tables: day-partitioned Parquet datasets.

Layout: ``<root>/<table>/ds=YYYY-MM-DD/part-*.parquet``.  A write replaces
exactly the days that it holds, so re-running a day never deletes another.  A
given day is written aside, to ``_aside`` under the root (which Spark's readers
pass over), and takes the old day's place by renames once the job is through;
a job that dies leaves the old day.  A read of one day lists that day only.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelens.contracts import CONTRACTS, conform
from lodgelens.sources import storage

PARTITION_COL = "ds"
ASIDE = "_aside"


class EmptyStageError(RuntimeError):
    """No partition exists under a table root."""


def _ds_lit(ds) -> F.Column:
    return F.lit(str(ds)).cast("date")


def write_partition(df: DataFrame, root: str, ds=None, num_files: int | None = None) -> str:
    """Idempotently replace the day(s) in ``df`` under ``root``.

    If ``ds`` is given, exactly that day's directory is replaced, also by no
    rows: an empty, typed partition stays.  The day is written aside first, so
    until it is whole readers have the old one.  Otherwise ``df`` must already
    carry a ``ds`` column (a backfill of many days in one job); the days it
    holds are replaced, and the ``rebalance`` hint merges small days into few
    files and splits large ones.
    """
    if ds is not None:
        day = _dt.date.fromisoformat(str(ds))
        out = df.drop(PARTITION_COL)
        out = out.repartition(num_files) if num_files else out
        aside = f"{root.rstrip('/')}/{ASIDE}/{uuid.uuid4().hex}"
        out.write.parquet(f"{aside}/new")
        return _take_place(df.sparkSession, root, day, aside)
    # round-robin, not by day: hashing on ``ds`` would put a whole day in one task
    out = df.repartition(num_files) if num_files else df.hint("rebalance", PARTITION_COL)
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(PARTITION_COL).parquet(root))
    return root


def _take_place(spark: SparkSession, root: str, day: _dt.date, aside: str) -> str:
    """Put ``aside``/new in the day's place; the old day waits in ``aside`` until then."""
    name = f"{PARTITION_COL}={day}"
    path = f"{root.rstrip('/')}/{name}"
    while True:
        if storage.exists(spark, path):
            old = f"{aside}/old-{uuid.uuid4().hex}"
            storage.make_folder(spark, old)
            storage.move(spark, path, f"{old}/{name}")
        try:
            storage.move(spark, f"{aside}/new", path)
        except storage.AlreadyThere:
            continue  # a rerun of the same day came between
        storage.remove(spark, aside)
        return path


def restore_days(spark: SparkSession, root: str) -> list[str]:
    """Put back days that a driver lost between the two renames left aside; the days' names."""
    back = []
    base = root.rstrip("/")
    for write in storage.names(spark, f"{base}/{ASIDE}", folders=True):
        for old in storage.names(spark, f"{base}/{ASIDE}/{write}", folders=True):
            for name in storage.names(spark, f"{base}/{ASIDE}/{write}/{old}", folders=True):
                if old.startswith("old-") and not storage.exists(spark, f"{base}/{name}"):
                    storage.move(spark, f"{base}/{ASIDE}/{write}/{old}/{name}", f"{base}/{name}")
                    back.append(name)
    return back


def write_scored(scored: DataFrame, root: str, ds) -> str:
    """Write scored reviews for one day (the same replacement of a day)."""
    return write_partition(scored, root, ds)


def read_table_root(spark: SparkSession, root: str) -> DataFrame:
    """Every day of a table (lists every file; prefer ``scan_curated_partition``)."""
    try:
        df = spark.read.parquet(root)
    except AnalysisException as e:
        raise EmptyStageError(f"no partitions under {root}") from e
    if PARTITION_COL not in df.columns:
        raise EmptyStageError(f"{root} is not partitioned by {PARTITION_COL}")
    return df


def list_days(spark: SparkSession, root: str) -> list[_dt.date]:
    """The ``ds=`` partition directories under ``root`` (directory names only:
    no data file is listed or opened, however many days the table holds)."""
    days = []
    for name in storage.names(spark, root, folders=True):
        if name.startswith(f"{PARTITION_COL}="):
            try:
                days.append(_dt.date.fromisoformat(name.split("=", 1)[1]))
            except ValueError:
                continue
    return sorted(days)


def scan_curated_partition(spark: SparkSession, root: str, ds) -> DataFrame:
    """Rows of one day.  Only that day's directory is listed and read
    (``basePath`` keeps ``ds`` as a column), so the cost does not grow with
    the number of days in the table."""
    day_path = f"{root.rstrip('/')}/{PARTITION_COL}={ds}"
    try:
        return spark.read.option("basePath", root).parquet(day_path)
    except AnalysisException as e:
        raise EmptyStageError(f"no partition {day_path}") from e


def resolve_ds(spark: SparkSession, root: str, requested=None) -> _dt.date:
    """The requested day if its partition exists, else the latest day, else
    an error.  Decided from the partition directory names alone."""
    days = list_days(spark, root)
    if not days:
        raise EmptyStageError(f"no partitions under {root}")
    if requested is not None:
        wanted = _dt.date.fromisoformat(str(requested))
        if wanted in days:
            return wanted
    return days[-1]


def load_snapshot(spark: SparkSession, root: str, table: str, ds) -> DataFrame:
    """One day of a curated table as a full warehouse snapshot: no ``ds``
    column, the contract's columns and types (missing ones as NULL; a column
    of another type is an error)."""
    day = scan_curated_partition(spark, root, ds).drop(PARTITION_COL)
    return conform(day, CONTRACTS[table], strict=True)


def preview(spark: SparkSession, root: str, ds, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows of one day of a written table, in key order."""
    return scan_curated_partition(spark, root, ds).orderBy(key).limit(n)


def empty_guard(df: DataFrame) -> bool:
    """True when there is nothing to process (reads at most one row)."""
    return df.isEmpty()
