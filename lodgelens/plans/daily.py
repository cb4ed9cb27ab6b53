"""The daily job: raw CSV -> curated partitions -> scored facts -> gates -> warehouse.

``run_day`` is what a scheduler calls once per day (``backfill`` loops over
days).  Each step reads what the previous step *wrote*, so lineage is cut at
every table boundary: a lost executor recomputes at most one step, and the
expensive scorer is never re-run to count or publish its output.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from lodgelens.contracts import FACT_REVIEWS, conform_columns
from lodgelens.operators import curate as C
from lodgelens.operators import dedupe as D
from lodgelens.operators import ledger as LE
from lodgelens.operators import quality as Q
from lodgelens.operators import rollups as RU
from lodgelens.operators import scoring as SC
from lodgelens.operators import word_weights as WW
from lodgelens.session import scratch_path
from lodgelens.sources import curated as CU
from lodgelens.sources import raw as R
from lodgelens.sources import warehouse as W

TABLES = ("dim_listing", "dim_date", "fact_reviews_stage", "fact_reviews")


@dataclasses.dataclass(frozen=True)
class ScoringKnobs:
    """Cost controls of the scoring step (0 or None switches a control off).

    ``ledger`` is a folder that remembers replies over reruns (see
    ``operators.ledger``); ``waves`` parts of the work are recorded one by one.
    ``weights`` is a stored table of ``word_weights.learn_weights``, by which
    texts are scored where no scorer is given.
    """
    max_rows: int = 0
    sample_frac: float = 0.0
    max_tokens: int = 0
    seed: int = 42
    batch_size: int = SC.BATCH_SIZE
    max_retries: int = SC.MAX_RETRIES
    base_sleep: float = SC.BASE_SLEEP_SEC
    parallelism: int | None = None
    max_concurrency: int | None = None
    max_chars: int = 0
    ledger: str | None = None
    weights: str | None = None
    waves: int = 1


class GateFailure(RuntimeError):
    def __init__(self, failed: list[dict]):
        super().__init__(f"data-quality gates failed: {failed}")
        self.failed = failed


def _root(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def _together(spark: SparkSession, *actions: Callable[[], object]) -> list:
    """Submit independent Spark actions as concurrent jobs.

    Each action is its own job; running them side by side keeps the cluster
    busy while one of them is in a narrow stage.  Threads inherit the
    caller's job properties (pinned-thread mode).
    """
    if len(actions) == 1:
        return [actions[0]()]
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]
        return [f.result() for f in futures]


def curate_day(spark: SparkSession, raw_root: str, curated_root: str, ds,
               loaded_at: _dt.datetime | None = None,
               place: C.Place = C.Place()) -> dict[str, str]:
    """Raw listings/reviews CSV -> dim_listing, dim_date, fact_reviews_stage for ``ds``."""
    clean_path = scratch_path(spark, "reviews-parsed")
    # Raw row counts and malformed rows are observed while the curation jobs
    # run (``observe``), so counting them costs no extra pass over the CSV.
    seen = {name: Observation(f"raw_{name}") for name in ("listings", "reviews")}
    listings = R.standardize_keys(R.scan_csv_raw(spark, _root(raw_root, "listings")), "listing_id")
    reviews = R.standardize_keys(R.scan_csv_raw(spark, _root(raw_root, "reviews")),
                                 "review_id", "listing_id")
    listings, reviews = (df.observe(seen[name], F.count(F.lit(1)).alias("rows"),
                                    F.count_if(F.col(R.CORRUPT_COL).isNotNull()).alias("malformed"))
                         for name, df in (("listings", listings), ("reviews", reviews)))
    listing_root = _root(curated_root, "dim_listing")
    # Parsed reviews go to Parquet in the shared folder, numbered, so neither
    # the CSV scan runs again nor do the steps that decide by keys and dates
    # read a text.  That is independent of the listing write; both run at once.
    wrote_listing, rows = _together(
        spark,
        lambda: CU.write_partition(C.build_dim_listing(listings, loaded_at, place), listing_root, ds),
        lambda: D.write_numbered(C.parse_reviews(reviews), ["review_id"], clean_path))
    dim_listing = CU.scan_curated_partition(spark, listing_root, ds)
    losers = D.losing_rows(rows, ["review_id"], [F.col("review_date")])
    gone = C.unwanted_reviews(rows, losers, dim_listing)
    wrote_date, wrote_stage = _together(
        spark,
        lambda: CU.write_partition(C.build_dim_date(D.without(rows, losers)), _root(curated_root, "dim_date"), ds),
        lambda: CU.write_partition(C.fact_stage(D.without(rows, gone)), _root(curated_root, "fact_reviews_stage"), ds))
    raw = {f"{name}_{k}": v for name, o in seen.items() for k, v in o.get.items()}
    return {"dim_listing": wrote_listing, "dim_date": wrote_date, "fact_reviews_stage": wrote_stage,
            "raw": raw}


def score_day(spark: SparkSession, curated_root: str, ds=None,
              scorer: Callable[[list[str]], str] | None = None,
              knobs: ScoringKnobs = ScoringKnobs()) -> tuple[_dt.date, int]:
    """Score the staged reviews of ``ds`` (or the latest staged day) and write
    ``fact_reviews`` for that day.  Returns (day, rows written).

    Without a ``scorer`` the stored word weights are used, or the offline
    lexicon rule where there are none; with one, rows go through ``score_batches``.
    """
    stage_root = _root(curated_root, "fact_reviews_stage")
    day = CU.resolve_ds(spark, stage_root, ds)
    stage = CU.scan_curated_partition(spark, stage_root, day).drop(CU.PARTITION_COL)
    picked = SC.select_scoring_input(stage, max_tokens=knobs.max_tokens,
                                     sample_frac=knobs.sample_frac, max_rows=knobs.max_rows,
                                     seed=knobs.seed)
    fact_root = _root(curated_root, "fact_reviews")
    if CU.empty_guard(picked):  # stops at the first row; no scorer is started for nothing
        none = picked.limit(0).withColumns({"sentiment_label": F.lit(None).cast("string"),
                                            "sentiment_score": F.lit(None).cast("double")})
        CU.write_scored(none.select(*conform_columns(none, FACT_REVIEWS), F.lit("ok").alias("parse_status")), fact_root, day)
        return day, 0
    if scorer is None and knobs.weights:
        scored = WW.score_texts(picked, spark.read.parquet(knobs.weights)).withColumn("parse_status", F.lit("ok"))
    elif scorer is None:
        scored = SC.lexicon_score(picked).withColumn("parse_status", F.lit("ok"))
    else:
        runner = dict(batch_size=knobs.batch_size, max_retries=knobs.max_retries, base_sleep=knobs.base_sleep,
                      parallelism=knobs.parallelism, max_concurrency=knobs.max_concurrency, max_chars=knobs.max_chars)
        scored = (LE.score_resumable(picked, scorer, knobs.ledger, knobs.waves, **runner) if knobs.ledger
                  else SC.score_batches(picked, scorer, **runner))
    out = scored.select(*conform_columns(scored, FACT_REVIEWS), "parse_status")
    CU.write_scored(out, fact_root, day)
    return day, CU.scan_curated_partition(spark, fact_root, day).count()


def load_day(spark: SparkSession, curated_root: str, ds) -> dict[str, DataFrame]:
    """The three warehouse tables of one day as snapshots (contract columns)."""
    return {
        "dim_listing": CU.load_snapshot(spark, _root(curated_root, "dim_listing"), "dim_listing", ds),
        "dim_date": CU.load_snapshot(spark, _root(curated_root, "dim_date"), "dim_date", ds),
        "fact_reviews": CU.load_snapshot(spark, _root(curated_root, "fact_reviews"), "fact_reviews", ds),
    }


def gate_day(spark: SparkSession, curated_root: str, ds) -> list[dict]:
    """Run the quality gates on one day; returns the (small) report rows."""
    t = load_day(spark, curated_root, ds)
    report = Q.quality_report(t["dim_listing"], t["dim_date"], t["fact_reviews"])
    return [r.asDict() for r in report.collect()]


def publish_day(spark: SparkSession, curated_root: str, warehouse_root: str, ds) -> W.Version:
    """Replace the three warehouse tables with the day's snapshot, all at once (TRUNCATE + COPY)."""
    return W.publish(spark, load_day(spark, curated_root, ds), warehouse_root, ds)


def run_day(spark: SparkSession, raw_root: str, curated_root: str, warehouse_root: str, ds,
            scorer: Callable[[list[str]], str] | None = None,
            knobs: ScoringKnobs = ScoringKnobs(), stop_on_failed_gates: bool = True,
            loaded_at: _dt.datetime | None = None, place: C.Place = C.Place()) -> dict:
    """Curate, score, gate and publish one day, also when it has no reviews, and update the kept views by it.

    A step that fails leaves the published version, and the days and views
    before, as they were.
    """
    curated = curate_day(spark, raw_root, curated_root, ds, loaded_at, place)
    day, scored_rows = score_day(spark, curated_root, ds, scorer, knobs)
    report = gate_day(spark, curated_root, day)
    failed = [r for r in report if not r["passed"]]
    if failed and stop_on_failed_gates:
        raise GateFailure(failed)
    published = publish_day(spark, curated_root, warehouse_root, day)
    views = RU.update_day(spark, curated_root, day)
    return {"ds": day, "curated": curated, "scored_rows": scored_rows, "rows": published.rows,
            "gates": report, "published": published.folders, "version": published.number, "views": views}


def backfill(spark: SparkSession, days: Iterable[tuple[str, object]], curated_root: str,
             warehouse_root: str, **kwargs) -> list[dict]:
    """``run_day`` for each ``(raw_root, ds)``; earlier days stay untouched."""
    return [run_day(spark, raw, curated_root, warehouse_root, ds, **kwargs) for raw, ds in days]
