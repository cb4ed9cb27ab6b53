"""The corpus pipeline: five stages over ``documents``, each by one operator of ``lodgelens.llm``.

Every stage but the last returns the columns of its input; each result is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lodgelens.llm import common, decontaminate, language, line_dedup, mixing, near_dup

#: Documents whose predicted language is less sure than this are rejected.
LEAST_SURE = 0.5
#: Words in a block of the final mix.
MIX_BLOCK = 256


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row's doc_id and text, null or not, and its name, which no column of ``docs`` has.

    Rows equal in both share the key (63 bits of a hash).
    """
    name = "_row_key"
    while name in docs.columns:
        name += "_"
    i, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.withColumn(name, F.xxhash64(i.isNull(), i, text.isNull(), text).bitwiseAND(F.lit((1 << 63) - 1))), name


def by_key(docs: DataFrame, key: str) -> DataFrame:
    """What the operators are given: the row key as doc_id, and the text."""
    return docs.select(F.col(key).alias("doc_id"), "text")


def without(docs: DataFrame, key: str, gone: DataFrame, tag: str) -> DataFrame:
    """``docs`` but for the rows whose keys ``gone`` holds as doc_id."""
    gone = common.small(common.stored(gone.select(F.col("doc_id").alias(key)).distinct(), tag), 16)
    return docs.join(gone, key, "left_anti")


def content_hash(docs: DataFrame, columns: list[str]) -> Column:
    """A hash of a row's columns; of a map its entries (Spark hashes no map)."""
    kinds = {f.name: f.dataType for f in docs.schema}
    return F.xxhash64(*[F.map_entries(c) if isinstance(kinds[c], MapType) else F.col(c) for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter or without a sure language."""
    rows, key = keyed(docs)
    found = language.identify(spark, by_key(rows, key), docs.where(~common.held_out()).select("text", "lang"))
    bad = found.where((F.col("lang_pred") == "und") | (F.col("score") < LEAST_SURE))
    return without(rows, key, bad, "language-rejected").select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated line chunks; a document of which nothing is left goes."""
    cut = line_dedup.dedup_lines(spark, docs)
    cut = cut.where("n_removed = 0 or trim(text) <> ''")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: the least doc_id (null last), and of rows equal in id and text one."""
    rows, key = keyed(docs)
    found = near_dup.near_duplicates(spark, by_key(rows, key)).where("n_shingles > 0")
    found = common.stored(found.groupBy(F.col("doc_id").alias("key"), "component_id").agg(F.count("*").alias("copies")), "near-found")
    groups = common.stored(found.groupBy("component_id").agg(F.count("*").alias("size")).where("size > 1"), "near-groups")
    linked = common.stored(common.met(found, groups, "component_id", 16).select("key", "component_id"), "near-linked")
    ids = rows.select(F.col(key).alias("key"), F.col("doc_id").cast("long").alias("id")).join(common.small(linked, 24), "key")
    place = F.struct(F.col("id").isNull(), "id", "key")
    first = common.stored(ids.groupBy("component_id").agg(F.min(place).alias("first")).select(F.col("first.key").alias("key")), "near-kept")
    left = without(rows, key, linked.join(common.small(first, 16), "key", "left_anti").select(F.col("key").alias("doc_id")), "near-dropped")
    copies = common.small(common.stored(found.where("copies > 1").select(F.col("key").alias(key)), "near-copies"), 16)
    row = F.min_by(F.struct(*docs.columns), content_hash(docs, docs.columns)).alias("row")
    one = left.join(copies, key, "left_semi").groupBy(key).agg(row)
    return left.join(copies, key, "left_anti").select(docs.columns).union(one.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows, key = keyed(docs)
    hit = decontaminate.contained(spark, by_key(rows, key), common.table(spark, sf_dir, "benchmark"))
    return without(rows, key, hit, "contaminated").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: shard, slot, source, block, doc_ids, text."""
    return mixing.mixed(spark, docs, MIX_BLOCK)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]
#: Hash-made chunks, sketches and permutations have no SQL twin; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
