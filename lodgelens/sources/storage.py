"""A few file operations through Spark's own file systems (HDFS, object stores, local), from the driver.

Names and small text files only: data files are read and written by Spark.
"""

from __future__ import annotations

from pyspark.errors.exceptions.base import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(RuntimeError):
    """The target of a rename that must not replace anything exists."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str, folders: bool) -> list[str]:
    """The names right under ``path`` (none if it isn't there): folders or files."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() == folders)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename in one step; never replaces ``target``."""
    sc = spark.sparkContext
    fs = sc._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(_fs(spark, target)[1].toUri(), sc._jsc.hadoopConfiguration())
    none = sc._gateway.new_array(fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(fs.Path(source)), context.makeQualified(fs.Path(target)), none)
    except (Py4JJavaError, PySparkException) as e:
        if "FileAlreadyExistsException" in str(e):
            raise AlreadyThere(target) from e
        raise


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
