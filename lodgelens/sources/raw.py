"""Raw CSV input: explicit all-string schema, one pass, permissive.

Schema inference would scan the input twice and let column types drift from
day to day; instead the header line alone gives the column names and every
column is read as a string, to be parsed with the ANSI-safe functions in
``lodgelens.functions``.  ``multiLine`` stays on because review comments hold
newlines; a multi-line CSV file is read by one task, so parallelism comes
from the number of input files (write raw drops as many files, not one;
``loads`` refuses files over a size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"

# Reader options for messy quoted CSV (RFC 4180 doubled quotes).
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "PERMISSIVE",
}


def _options(multi_line: bool, extra: dict | None) -> dict:
    opts = dict(CSV_OPTIONS)
    opts["multiLine"] = "true" if multi_line else "false"
    opts.update(extra or {})
    return opts


def csv_header(spark: SparkSession, path: str | list[str], multi_line: bool = True,
               options: dict | None = None) -> list[str]:
    """Column names from the header line (no inference pass over the data)."""
    opts = _options(multi_line, options)
    return spark.read.options(**opts).csv(path).columns


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim and lower-case every column name in one projection; fail on clashes."""
    names = [c.strip().lower() for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalisation: {dupes}")
    return df.toDF(*names)


def standardize_keys(df: DataFrame, key: str, *also_string: str) -> DataFrame:
    """Rename ``id`` to ``key`` when ``key`` is absent; cast keys to string."""
    if key not in df.columns and "id" in df.columns:
        df = df.withColumnRenamed("id", key)
    casts = {k: F.col(k).cast("string") for k in (key, *also_string) if k in df.columns}
    return df.withColumns(casts) if casts else df


def scan_csv_raw(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                 multi_line: bool = True, options: dict | None = None, file_col: str | None = None) -> DataFrame:
    """Read a raw CSV directory, or files (gzip accepted), with every column as string.

    Rows that do not fit the header (too short or too long) keep what could
    be read and carry the raw line in ``_corrupt_record`` so gates can count
    them.  Column names are normalised (trimmed, lower case).  ``file_col``
    adds the file that a row was read from.
    """
    opts = _options(multi_line, options)
    names = columns or csv_header(spark, path, multi_line, options)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names]
                          + [T.StructField(CORRUPT_COL, T.StringType())])
    df = (spark.read.schema(schema).options(**opts)
          .option("columnNameOfCorruptRecord", CORRUPT_COL).csv(path))
    if not file_col:
        return normalize_columns(df)
    out = normalize_columns(df.select("*", F.col("_metadata.file_path").alias("_source_file")))
    return out.withColumnRenamed("_source_file", file_col)


def write_csv_raw(df: DataFrame, path: str, num_files: int | None = None) -> str:
    """Write a DataFrame as raw CSV the way the scan expects it (header,
    doubled-quote escaping, whitespace kept).  Used to land raw drops."""
    out = df.repartition(num_files) if num_files else df
    (out.write.mode("overwrite")
     .option("header", "true").option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
    return path
