"""Raw drops loaded by files: what was read is remembered, and looked over before it counts.

``read_new`` lists a drop's files (path, length, modification time; Spark lists
them, nothing is opened) and scans those that the load ledger doesn't hold, with
the file of each row.  ``file_report`` counts rows and malformed rows by file;
``check`` holds the report against limits: the share of malformed rows, the size
of a file (a multi-line file is read by one task, whatever its size), files
without a row, and rows loaded against rows observed.  ``commit`` writes the
report to the ledger, once what was loaded is in place; a load that isn't
committed is read again.  A file that was changed counts as new.

The ledger holds a row a file, in one part a load.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelens.session import scratch_path
from lodgelens.sources import raw as R
from lodgelens.sources import storage

FILE = "_file"
LEDGER = "path string, length long, modified timestamp, rows long, malformed long"
SEEN = ["path", "length", "modified"]


class LoadRefused(RuntimeError):
    def __init__(self, findings: list[dict]):
        super().__init__(f"raw files refused: {findings[:20]}{' ...' if len(findings) > 20 else ''}")
        self.findings = findings


def files(spark: SparkSession, path: str) -> DataFrame:
    """path, length, modified of the files under ``path``; contents aren't read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", F.col("length"), F.col("modificationTime").alias("modified"))


def seen_files(spark: SparkSession, ledger_root: str) -> DataFrame:
    base = ledger_root.rstrip("/")
    parts = [f"{base}/{n}" for n in storage.names(spark, base, folders=True)
             if n.startswith("load=") and storage.exists(spark, f"{base}/{n}/_SUCCESS")]
    return spark.read.schema(LEDGER).parquet(*parts) if parts else spark.createDataFrame([], LEDGER)


def new_files(spark: SparkSession, path: str, ledger_root: str) -> DataFrame:
    return files(spark, path).join(seen_files(spark, ledger_root).select(*SEEN), SEEN, "left_anti")


def read_new(spark: SparkSession, path: str, ledger_root: str, **scan) -> tuple[DataFrame | None, list[str]]:
    """(rows of the files not loaded yet, their paths); None if there is none.

    The scan is ``raw.scan_csv_raw`` over those files, with the file of each
    row in ``_file``.  The names of the new files go through the driver, as
    with any read of listed files.
    """
    try:
        paths = sorted(r.path for r in new_files(spark, path, ledger_root).select("path").collect())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None, []
        raise
    if not paths:
        return None, []
    return R.scan_csv_raw(spark, paths, file_col=FILE, **scan), paths


def file_report(spark: SparkSession, path: str, rows: DataFrame, paths: list[str]) -> DataFrame:
    """LEDGER rows of the loaded files, from their rows (written as Parquet before); a file without a row counts 0."""
    per = rows.groupBy(F.col(FILE).alias("path")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(R.CORRUPT_COL).isNotNull()).alias("malformed"))
    names = spark.createDataFrame([(p,) for p in paths], "path string")
    none = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("rows", "malformed")]
    return files(spark, path).join(names, "path").join(per, "path", "left").select(*SEEN, *none)


def check(report: DataFrame, most_malformed: float = 0.01, most_bytes: int = 1 << 30, observed_rows: int | None = None) -> list[dict]:
    """What is wrong with a load: (check, path, value) by file and, with ``observed_rows``, for the whole."""
    share = F.col("malformed") / F.greatest(F.col("rows"), F.lit(1))
    found = [F.when(share > most_malformed, F.struct(F.lit("malformed_share").alias("check"), "path", share.alias("value"))),
             F.when(F.col("length") > most_bytes, F.struct(F.lit("file_bytes").alias("check"), "path", F.col("length").cast("double").alias("value"))),
             F.when((F.col("rows") == 0) & (F.col("length") > 0), F.struct(F.lit("no_rows").alias("check"), "path", F.lit(0.0).alias("value")))]
    findings = [r.asDict() for r in report.select(F.explode(F.array_compact(F.array(*found))).alias("f")).select("f.*").orderBy("check", "path").collect()]
    if observed_rows is not None:
        loaded = report.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if loaded != observed_rows:
            findings.append({"check": "rows_loaded", "path": None, "value": float(loaded - observed_rows)})
    return findings


def commit(report: DataFrame, ledger_root: str) -> str:
    """Remember the report's files."""
    path = f"{ledger_root.rstrip('/')}/load={uuid.uuid4().hex}"
    report.select(*[c.split()[0] for c in LEDGER.split(", ")]).write.parquet(path)
    return path


def load(spark: SparkSession, path: str, ledger_root: str, place, limits: dict | None = None, **scan) -> DataFrame | None:
    """Scan the new files, hand the rows to ``place`` (which puts them somewhere and returns the number of rows, or None),
    check, and commit; the report, or None without new files.  Refused loads aren't committed.

    The text files are parsed once, to Parquet in the shared scratch folder.
    """
    found, paths = read_new(spark, path, ledger_root, **scan)
    if found is None:
        return None
    parsed = scratch_path(spark, "raw-rows")
    found.write.parquet(parsed)
    rows = spark.read.schema(found.schema).parquet(parsed)
    stored = place(rows)
    report = file_report(spark, path, rows, paths)
    findings = check(report, observed_rows=stored, **(limits or {}))
    if findings:
        raise LoadRefused(findings)
    return spark.read.schema(LEDGER).parquet(commit(report, ledger_root))
