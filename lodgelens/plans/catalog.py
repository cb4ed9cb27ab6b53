"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each bound to the stand-in tables (see ``sources.standins``).

Every query reads whole tables (no id subsets, row caps or prefixes); a
LIMIT appears only where the top-k or the sampling cap is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodgelens.operators import adhoc as A
from lodgelens.operators import analysis as AN
from lodgelens.operators import curate as C
from lodgelens.functions import exprs as X
from lodgelens.operators import ledger as LE
from lodgelens.operators import quality as Q
from lodgelens.operators import percentiles as PC
from lodgelens.operators import rollups as RU
from lodgelens.operators import sampling as SM
from lodgelens.operators import scoring as SC
from lodgelens.operators import word_weights as WW
from lodgelens.plans import daily as P
from lodgelens.session import scratch_path
from lodgelens.sources import curated as CU
from lodgelens.sources import loads as L
from lodgelens.sources import raw as R
from lodgelens.sources import standins as S
from lodgelens.sources import warehouse as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str | None = None):
    def deco(fn):
        QUERIES[name or fn.__name__] = fn
        return fn
    return deco


def _listing(spark, sf, city=False):
    return S.listings_from_part(spark, sf, with_city=city)


def _fact(spark, sf):
    return S.reviews_from_lineitem(spark, sf)


def _review_calendar(spark, sf):
    return C.build_dim_date(_fact(spark, sf), "review_date")


def _order_calendar(spark, sf):
    o = S.read_table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    return C.build_dim_date(o, "d")


# ----------------------------------------------------------------- analyses
@register()
def supply_mix(spark, sf):
    return AN.supply_mix(_listing(spark, sf))


@register()
def price_landscape(spark, sf):
    return AN.price_landscape(_listing(spark, sf))


@register()
def exact_percentiles(spark, sf):
    """Quantiles of the order totals by priority, one distinct price an order."""
    at = {"lowest": 0.0, "p25": 0.25, "median": 0.5, "p99": 0.99, "highest": 1.0}
    found = PC.exact_percentiles(S.read_table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", at)
    return found.select("o_orderpriority", "n", *[X.round_half_up(F.col(c), 4).alias(c) for c in at])


@register()
def top_neighbourhoods_5(spark, sf):
    return AN.top_neighbourhoods(_listing(spark, sf), 5)


@register()
def top_neighbourhoods_20(spark, sf):
    return AN.top_neighbourhoods(_listing(spark, sf), 20)


@register()
def superhost_compare(spark, sf):
    return AN.superhost_compare(_listing(spark, sf))


@register()
def instant_book_compare(spark, sf):
    return AN.instant_book_compare(_listing(spark, sf))


@register()
def reviews_by_month(spark, sf):
    return AN.reviews_by_month(_fact(spark, sf), _review_calendar(spark, sf))


@register()
def sentiment_split(spark, sf):
    return AN.sentiment_split(_fact(spark, sf))


@register()
def sentiment_by_city(spark, sf):
    return AN.sentiment_by_city(_fact(spark, sf), _listing(spark, sf, city=True))


@register()
def sentiment_by_price_band(spark, sf):
    return AN.sentiment_by_price_band(_fact(spark, sf), _listing(spark, sf))


@register()
def best_worst_listings(spark, sf):
    return AN.best_worst_listings(_fact(spark, sf))


@register()
def availability_signal(spark, sf):
    return AN.availability_signal(_listing(spark, sf))


@register()
def value_picks(spark, sf):
    return AN.value_picks(_listing(spark, sf))


@register()
def vw_listing_sentiment(spark, sf):
    return AN.vw_listing_sentiment(_fact(spark, sf))


@register()
def vw_city_sentiment_daily(spark, sf):
    return AN.vw_city_sentiment_daily(_fact(spark, sf), _listing(spark, sf, city=True),
                                      _review_calendar(spark, sf))


@register()
def listing_kpi_attach(spark, sf):
    return AN.listing_kpi_attach(_listing(spark, sf, city=True), _fact(spark, sf))


@register()
def build_dim_date(spark, sf):
    return _order_calendar(spark, sf)


# ------------------------------------------------------------------- ad-hoc
@register()
def filter_column_vs_column(spark, sf):
    return A.filter_column_vs_column(_listing(spark, sf))


@register()
def filter_price_over(spark, sf):
    return A.filter_price_over(S.listings_from_orders(spark, sf))


@register()
def filter_conjunction(spark, sf):
    return A.filter_conjunction(_listing(spark, sf))


@register()
def filter_disjunction(spark, sf):
    return A.filter_disjunction(_listing(spark, sf))


@register()
def max_price(spark, sf):
    return A.max_price(_listing(spark, sf))


@register()
def distinct_hosts(spark, sf):
    return A.distinct_hosts(S.listings_from_orders(spark, sf))


@register()
def host_stats(spark, sf):
    return A.host_stats(_listing(spark, sf))


@register()
def reviews_per_listing(spark, sf):
    return A.reviews_per_listing(_fact(spark, sf))


@register()
def top_reviewed_listings(spark, sf):
    return A.top_reviewed_listings(_fact(spark, sf))


@register()
def join_listing_reviews(spark, sf):
    return A.join_listing_reviews(S.text_listings(spark, sf), S.text_reviews(spark, sf))


@register()
def join_sql_inner(spark, sf):
    return A.join_sql_inner(spark, S.text_listings(spark, sf), S.text_reviews(spark, sf))


@register()
def semi_join_known_listings(spark, sf):
    return A.semi_join_known_listings(S.reviews_by_order(spark, sf), S.listings_from_orders(spark, sf))


@register()
def anti_join_unreviewed(spark, sf):
    return A.anti_join_unreviewed(S.listings_from_orders(spark, sf), S.reviews_by_order(spark, sf))


@register()
def price_category_counts(spark, sf):
    return A.price_category_counts(_listing(spark, sf))


@register()
def comment_length_by_listing(spark, sf):
    reviews = S.text_reviews(spark, sf, listing_col="source")
    listings = reviews.select("listing_id").distinct()
    return A.comment_length_by_listing(spark, reviews, listings)


@register()
def listing_age_by_host(spark, sf):
    return A.listing_age_by_host(S.listings_from_orders(spark, sf), as_of="2002-01-01")


# ----------------------------------------------------------- de-duplication
@register()
def dedupe_by_key(spark, sf):
    cols = ["review_id", "listing_id", "date_key", "sentiment_label", "sentiment_score", "review_date"]
    f = _fact(spark, sf).select(*cols)
    return C.dedupe_by_key(f, "review_id", order_by=[F.col("review_date")])


# ------------------------------------------------------------ quality gates
@register()
def dq_row_counts(spark, sf):
    return Q.dq_row_counts({"dim_date": _review_calendar(spark, sf),
                            "dim_listing": _listing(spark, sf),
                            "fact_reviews": _fact(spark, sf)})


@register()
def dq_null_keys(spark, sf):
    return Q.dq_null_keys({"dim_date": (_review_calendar(spark, sf), "date_key"),
                           "dim_listing": (_listing(spark, sf), "listing_id"),
                           "fact_reviews": (_fact(spark, sf), "review_id")})


@register()
def dq_duplicate_keys(spark, sf):
    return Q.dq_duplicate_keys({"dim_listing": (_listing(spark, sf), "listing_id"),
                                "fact_reviews": (_fact(spark, sf), "review_id")})


@register()
def dq_orphans(spark, sf):
    return Q.dq_orphans(_fact(spark, sf), _listing(spark, sf), _order_calendar(spark, sf))


@register()
def dq_ranges(spark, sf):
    return Q.dq_ranges(_listing(spark, sf))


# ------------------------------------------------------- scalar parsing rules
# Each query builds messy input strings from table columns with a fixed
# vocabulary of shapes, then parses them; every row of the table is used.

# The raw string shapes fed to the parsers.
BOOL_SPELLINGS = ["t", "TRUE", "1", "y", "Yes", "f", "0", "junk", ""]


@register()
def parse_price(spark, sf):
    o = S.read_table(spark, sf, "orders")
    money = F.format_number(F.col("o_totalprice"), 2)
    shape = F.col("o_orderkey") % 4
    raw = (F.when(shape == 0, F.concat(F.lit("$"), money))
            .when(shape == 1, F.concat(F.lit("-$"), money))
            .when(shape == 2, F.lit("N/A"))
            .otherwise(F.concat(money, F.lit(".00"))))
    return o.select(F.col("o_orderkey").alias("key"), X.parse_price(raw).alias("price"))


@register()
def parse_percent(spark, sf):
    p = S.read_table(spark, sf, "part")
    rate = ((F.col("p_size") * 2) % 101).cast("string")
    shape = F.col("p_partkey") % 4
    raw = (F.when(shape == 0, F.concat(rate, F.lit("%")))
            .when(shape == 1, F.concat(F.lit(" "), rate, F.lit(" %")))
            .when(shape == 2, F.lit("N/A"))
            .otherwise(F.lit("%")))
    return p.select(F.col("p_partkey").alias("key"), X.parse_percent(raw).alias("rate"))


@register()
def parse_bool(spark, sf):
    p = S.read_table(spark, sf, "part")
    spellings = F.array(*[F.lit(s) for s in BOOL_SPELLINGS])
    raw = F.when(F.col("p_partkey") % 11 == 0, F.lit(None).cast("string")) \
           .otherwise(F.element_at(spellings, (F.col("p_size") % len(BOOL_SPELLINGS) + 1).cast("int")))
    return p.select(F.col("p_partkey").alias("key"), X.parse_bool(raw).alias("flag"))


@register()
def parse_bathrooms(spark, sf):
    p = S.read_table(spark, sf, "part")
    b_shape, t_shape = F.col("p_size") % 3, F.col("p_partkey") % 3
    bathrooms = (F.when(b_shape == 0, (F.col("p_size") % 4).cast("string"))
                  .when(b_shape == 1, F.lit("abc")))
    text = (F.when(t_shape == 0, F.concat((F.col("p_size") % 5).cast("string"), F.lit(".5 baths")))
             .when(t_shape == 1, F.lit("Half-bath"))
             .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" shared baths"))))
    return p.select(F.col("p_partkey").alias("key"), X.parse_bathrooms(bathrooms, text).alias("bathrooms"))


@register()
def parse_date(spark, sf):
    o = S.read_table(spark, sf, "orders")
    d, shape = F.col("o_orderdate"), F.col("o_orderkey") % 4
    raw = (F.when(shape == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(shape == 1, F.date_format(d, "yyyy-M-d"))
            .when(shape == 2, F.date_format(d, "MM/dd/yyyy"))
            .otherwise(F.lit("bad")))
    return o.select(F.col("o_orderkey").alias("key"), X.parse_date(raw).alias("d"))


@register()
def amenities_count(spark, sf):
    p = S.read_table(spark, sf, "part")
    quoted = F.regexp_replace(F.col("p_name"), " ", '","')
    shape = F.col("p_partkey") % 4
    raw = (F.when(shape == 0, F.concat(F.lit('["'), quoted, F.lit('"]')))
            .when(shape == 1, F.regexp_replace(F.col("p_name"), " ", " , "))
            .when(shape == 2, F.concat(F.lit('["'), quoted, F.lit('"')))
            .otherwise(F.concat(F.lit('["", "'), quoted, F.lit('"]'))))
    return p.select(F.col("p_partkey").alias("key"), X.amenities_count(raw).alias("amenities_count"))


@register()
def token_count(spark, sf):
    d = S.read_table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("key"), X.token_count(F.col("text")).alias("tokens_ct"))


# ------------------------------------------------------------------ scoring
# Knobs of the documented example run: {"max_rows": 2000, "sample_frac": 0.1,
# "max_tokens": 80, "seed": 42}.
SCORING_KNOBS = dict(max_rows=2000, sample_frac=0.1, max_tokens=80, seed=42)


def _text_stage(spark, sf):
    """Documents as a fact_reviews_stage (review_id = doc_id, whole texts)."""
    d = S.read_table(spark, sf, "documents")
    return d.select(F.col("doc_id").cast("string").alias("review_id"),
                    F.col("source").alias("listing_id"),
                    F.col("text").alias("comments"),
                    X.token_count(F.col("text")).alias("tokens_ct"))


@register()
def select_scoring_input(spark, sf):
    picked = SC.select_scoring_input(_text_stage(spark, sf), **SCORING_KNOBS)
    return picked.select("review_id", "tokens_ct")


@register()
def sample_fraction(spark, sf):
    d = S.read_table(spark, sf, "documents").select("doc_id")
    return SM.sample_fraction(d, 0.1, 42, "doc_id")


@register()
def sample_cap(spark, sf):
    d = S.read_table(spark, sf, "documents").select("doc_id")
    return SM.sample_cap(d, 100, 42, "doc_id")


@register()
def lexicon_score(spark, sf):
    d = S.read_table(spark, sf, "documents").select("doc_id", "text")
    return SC.lexicon_score(d, "text").select("doc_id", "sentiment_label", "sentiment_score")


def _weights(spark, sf):
    labelled = S.read_table(spark, sf, "labels").join(S.read_table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return WW.learn_weights(labelled, "text", F.col("quality") == 1)


@register()
def learn_weights(spark, sf):
    return _weights(spark, sf)


@register()
def score_texts(spark, sf):
    d = S.read_table(spark, sf, "documents").select("doc_id", "text")
    return WW.score_texts(d, _weights(spark, sf), "text").select("doc_id", "evidence", "sentiment_label", "sentiment_score")


@register()
def score_batches(spark, sf):
    d = S.read_table(spark, sf, "documents").select("doc_id", "text")
    scored = SC.score_batches(d, SC.LexiconReplyScorer(), text_col="text", base_sleep=0.0)
    return scored.select("doc_id", "sentiment_label", "sentiment_score", "parse_status")


@register()
def score_batches_capped(spark, sf):
    """The scorer sees the first 1,000 characters of a text, as a remote model would."""
    d = S.read_table(spark, sf, "documents").select("doc_id", "text")
    scored = SC.score_batches(d, SC.LexiconReplyScorer(), text_col="text", base_sleep=0.0, max_chars=X.MAX_PROMPT_CHARS)
    return scored.select("doc_id", "sentiment_label", "sentiment_score", "parse_status")


@register()
def score_resumable(spark, sf):
    """Two runs with one ledger: the first fails on texts whose length is a
    multiple of 3; the second would answer all alike, fails on multiples of 9,
    and is asked only about what the first left open."""
    root = scratch_path(spark, "ledger")
    d = S.read_table(spark, sf, "documents").select("doc_id", "text")
    knobs = dict(key="doc_id", text_col="text", batch_size=1, max_retries=1, base_sleep=0.0)
    LE.score_resumable(d, SC.ScheduledFailures(SC.LexiconReplyScorer(), 3), root, waves=2, **knobs)
    second = SC.ScheduledFailures(SC.ConstantReplyScorer("POSITIVE", 0.25), 9)
    return LE.score_resumable(d, second, root, **knobs).drop("text")


@register()
def truncate_text(spark, sf):
    d = S.read_table(spark, sf, "documents")
    cut = X.truncate_text(F.col("text"))
    return d.select("doc_id", F.md5(cut.cast("binary")).alias("cut_md5"), F.length(cut).alias("n_chars_cut"))


def _labels_replies(spark, sf) -> DataFrame:
    """Model replies synthesised from ``labels``: documents are batched by
    ``doc_id div 4`` (at most four per batch) and each batch gets one reply,
    in one of six shapes (clean, wrapped in prose, lower-case/unknown labels,
    one item short, no JSON, bad or out-of-range confidences)."""
    lb = S.read_table(spark, sf, "labels").select(
        "doc_id", "quality", "toxic", F.floor(F.col("doc_id") / 4).alias("batch_id"))
    shape = F.col("batch_id") % 6
    label = F.when(F.col("quality") == 1, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE"))
    label = (F.when((shape == 2) & (F.col("toxic") == 1), F.lit("neutral"))
              .when(shape == 2, F.lower(label)).otherwise(label))
    conf = (F.lit(0.5) + (F.col("doc_id") % 4).cast("double") * 0.125).cast("string")
    conf = (F.when((shape == 5) & (F.col("toxic") == 1), F.lit('"high"'))
             .when(shape == 5, F.lit("2")).otherwise(conf))
    item = F.concat(F.lit('{"label": "'), label, F.lit('", "confidence": '), conf, F.lit("}"))
    w = Window.partitionBy("batch_id").orderBy("doc_id")
    rows = lb.select("doc_id", "batch_id", shape.alias("shape"), item.alias("item"),
                     (F.row_number().over(w) - 1).cast("int").alias("pos"),
                     F.count(F.lit(1)).over(Window.partitionBy("batch_id")).cast("int").alias("n"))
    keep = (F.col("shape") != 3) | (F.col("pos") < F.col("n") - 1)
    kept_items = F.collect_list(F.when(keep, F.struct("pos", "item")))
    body = (rows.groupBy("batch_id", "shape")
            .agg(F.array_join(F.transform(F.array_sort(kept_items),
                                          lambda s: s.getField("item")), ", ").alias("items")))
    js = F.concat(F.lit('{"results": ['), F.coalesce(F.col("items"), F.lit("")), F.lit("]}"))
    reply = (F.when(F.col("shape") == 1, F.concat(F.lit("Sure, here you go:\n"), js, F.lit("\nThanks!")))
              .when(F.col("shape") == 4, F.lit("I cannot classify these reviews."))
              .otherwise(js))
    replies = body.select("batch_id", reply.alias("reply"))
    return rows.join(replies, "batch_id", "left").select("doc_id", "pos", "n", "reply")


@register()
def parse_model_reply(spark, sf):
    r = _labels_replies(spark, sf)
    p = SC.parse_model_reply(F.col("reply"), F.col("n"), F.col("pos"))
    return r.select("doc_id", p.alias("p")).select("doc_id", "p.*")


# ------------------------------------------------- sources and sinks (round trips)
# These write to a fresh folder under spark.checkpoint.dir and read it back.


def _raw_files(spark) -> int:
    """Raw drops land as several files, as real drops do: a multi-line CSV
    file is read by one task, so the file count is the scan's parallelism."""
    return spark.sparkContext.defaultParallelism

@register()
def scan_csv_raw(spark, sf):
    d = S.read_table(spark, sf, "documents")
    raw = d.select(F.col("doc_id").alias(" Doc_ID "), F.col("text").alias("Text"),
                   F.col("n_chars").alias("N_Chars "))
    path = R.write_csv_raw(raw, scratch_path(spark, "raw-documents"), _raw_files(spark))
    back = R.scan_csv_raw(spark, path)
    return back.select("doc_id", "text", X.parse_long(F.col("n_chars")).alias("n_chars"),
                       F.col(R.CORRUPT_COL).isNotNull().alias("corrupt"))


@register()
def load_new_files(spark, sf):
    """Two loads of a growing drop: all documents, then a second delivery of the
    German ones beside them, of which only the new files are read."""
    drop, ledger, out = (scratch_path(spark, n) for n in ("drop", "load-ledger", "loaded"))
    d = S.read_table(spark, sf, "documents").select(F.col("doc_id").alias("Doc_ID"), F.col("text").alias("Text"), F.col("lang").alias("lang"))
    for load, rows in ((1, d), (2, d.where("lang = 'de'"))):
        R.write_csv_raw(rows, f"{drop}/delivery-{load}", _raw_files(spark))

        def place(new: DataFrame, to=f"{out}/load={load}") -> int:
            new.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("text_md5")).write.parquet(to)
            return spark.read.parquet(to).count()
        L.load(spark, drop, ledger, place)
    return spark.read.option("basePath", out).parquet(out).select("doc_id", "text_md5", F.col("load").cast("int").alias("load"))


def _raw_listings(spark, sf) -> DataFrame:
    """A messy raw listings drop built from ``part``: money strings, 't'/'f'
    flags, percent strings, JSON amenities with quotes and commas, mixed
    header case; parts with p_size > 45 are listed twice."""
    p = S.read_table(spark, sf, "part")
    size, key = F.col("p_size"), F.col("p_partkey")
    price = (F.round(F.col("p_retailprice") * 10).cast("long") - 9000).cast("double") * 0.5
    baths = (size % 7).cast("double") * 0.5
    rows = p.select(
        key.cast("string").alias("ID"),
        (key % 100).cast("string").alias("Host_ID"),
        F.col("p_type").alias("Property_Type"),
        F.col("p_type").alias("room_type"),
        (size % 8 + 1).cast("string").alias("accommodates"),
        F.concat(F.lit("$"), F.format_number(price, 2)).alias("price"),
        F.when(size % 2 == 0, baths.cast("string")).alias("bathrooms"),
        F.concat(baths.cast("string"), F.lit(" baths")).alias("bathrooms_text"),
        (size % 5).cast("string").alias("bedrooms"),
        F.col("p_brand").alias("neighbourhood_cleansed"),
        (size % 31).cast("string").alias("availability_30"),
        size.cast("string").alias("number_of_reviews"),
        (F.lit(1.0) + (size % 17).cast("double") * 0.25).cast("string").alias("review_scores_rating"),
        F.when(size % 7 == 0, F.lit(None).cast("string"))
         .when(size % 2 == 0, F.lit("t")).otherwise(F.lit("f")).alias("host_is_superhost"),
        F.concat(((size * 2) % 101).cast("string"), F.lit("%")).alias("host_response_rate"),
        F.when(key % 5 == 0, F.lit("N/A"))
         .otherwise(F.concat(((size * 3) % 101).cast("string"), F.lit("%"))).alias("host_acceptance_rate"),
        F.when(key % 3 == 0, F.lit("t")).otherwise(F.lit("f")).alias("instant_bookable"),
        F.concat(F.lit('["'), F.regexp_replace(F.col("p_name"), " ", '", "'), F.lit('"]')).alias("amenities"),
    )
    return rows.unionByName(rows.where(F.col("number_of_reviews").cast("int") > 45))


@register()
def build_dim_listing(spark, sf):
    path = R.write_csv_raw(_raw_listings(spark, sf), scratch_path(spark, "raw-listings"), _raw_files(spark))
    raw = R.standardize_keys(R.scan_csv_raw(spark, path), "listing_id")
    dim = C.build_dim_listing(raw)
    return dim.select("listing_id", "host_id", "city", "state", "country", "property_type",
                      "room_type", "capacity", "price", "price_bucket", "bathrooms", "bedrooms",
                      "neighbourhood_cleansed", "availability_30", "number_of_reviews",
                      "review_scores_rating", "host_is_superhost", "host_response_rate",
                      "host_acceptance_rate", "instant_bookable", "amenities_count")


def _raw_reviews(spark, sf) -> DataFrame:
    """A raw reviews drop built from ``documents``: German documents carry an
    unreadable date; documents of source src0 are delivered twice."""
    d = S.read_table(spark, sf, "documents")
    day = F.lpad((F.col("n_chars") % 28 + 1).cast("string"), 2, "0")
    rows = d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id").cast("string").alias("listing_id"),
        F.when(F.col("lang") == "de", F.lit("not a date"))
         .otherwise(F.concat(F.lit("2024-09-"), day)).alias("date"),
        F.col("text").alias("comments"),
        F.col("source").alias("_source"),
    )
    return rows.unionByName(rows.where(F.col("_source") == "src0")).drop("_source")


@register()
def build_fact_stage(spark, sf):
    path = R.write_csv_raw(_raw_reviews(spark, sf), scratch_path(spark, "raw-reviews"), _raw_files(spark))
    raw = R.standardize_keys(R.scan_csv_raw(spark, path), "review_id", "listing_id")
    reviews = C.clean_reviews(raw)
    dim = S.text_listings(spark, sf)
    return C.build_fact_stage(reviews, dim)


def _events_by_day(spark, sf) -> DataFrame:
    e = S.read_table(spark, sf, "events")
    return e.select("event_id", "event_type", "value", F.to_date("ts").alias("ds"))


@register()
def write_partition(spark, sf):
    """Write every day, then rewrite the first day with its clicks only:
    the other days must survive (dynamic partition overwrite)."""
    root = scratch_path(spark, "events")
    ev = _events_by_day(spark, sf)
    CU.write_partition(ev, root)
    first = ev.agg(F.min("ds")).first()[0]
    CU.write_partition(ev.where((F.col("ds") == F.lit(first)) & (F.col("event_type") == "click"))
                       .drop("ds"), root, first)
    return spark.read.parquet(root).select("event_id", "event_type", "ds")


@register()
def scan_curated_partition(spark, sf):
    root = scratch_path(spark, "events")
    ev = _events_by_day(spark, sf)
    CU.write_partition(ev, root)
    first = ev.agg(F.min("ds")).first()[0]
    return CU.scan_curated_partition(spark, root, first).select("event_id", "event_type", "value", "ds")


@register()
def resolve_ds(spark, sf):
    """Ask for a day that does not exist: the latest day is used instead."""
    root = scratch_path(spark, "events")
    CU.write_partition(_events_by_day(spark, sf), root)
    day = CU.resolve_ds(spark, root, requested="1999-12-31")
    return (CU.scan_curated_partition(spark, root, day)
            .groupBy("ds").agg(F.count(F.lit(1)).alias("events")))


@register()
def load_snapshot(spark, sf):
    """Two days of dim_listing (day two re-priced by +100); load day two."""
    root = scratch_path(spark, "dim_listing")
    day1 = S.listings_from_part(spark, sf)
    day2 = day1.withColumn("price", F.col("price") + 100).withColumn(
        "price_bucket", X.price_bucket(F.col("price")))
    CU.write_partition(day1, root, "2024-09-01")
    CU.write_partition(day2, root, "2024-09-02")
    snap = CU.load_snapshot(spark, root, "dim_listing", "2024-09-02")
    return snap.select("listing_id", "host_id", "price", "price_bucket", "review_scores_rating", "city")


@register()
def write_scored(spark, sf):
    root = scratch_path(spark, "fact_reviews")
    stage = _text_stage(spark, sf)
    scored = SC.lexicon_score(stage, "comments")
    CU.write_scored(scored, root, "2024-09-01")
    back = CU.load_snapshot(spark, root, "fact_reviews", "2024-09-01")
    return back.select("review_id", "tokens_ct", "sentiment_label", "sentiment_score")


@register()
def preview(spark, sf):
    root = scratch_path(spark, "dim_listing")
    CU.write_partition(S.listings_from_part(spark, sf), root, "2024-09-01")
    return CU.preview(spark, root, "2024-09-01", "listing_id").select(
        "listing_id", "host_id", "price", "price_bucket", "room_type")


@register()
def publish_version(spark, sf):
    """Three publications of all three tables: a day, the next day re-priced by
    +100, and one whose facts fail to be written.  The second stays visible."""
    root = scratch_path(spark, "warehouse")
    listing, fact, dates = S.listings_from_part(spark, sf), _fact(spark, sf), _review_calendar(spark, sf)
    dearer = listing.withColumn("price", F.col("price") + 100)
    W.publish(spark, {"dim_listing": listing, "dim_date": dates, "fact_reviews": fact}, root, "2024-09-01")
    W.publish(spark, {"dim_listing": dearer, "dim_date": dates, "fact_reviews": fact}, root, "2024-09-02")
    lost = F.when(F.col("review_id").isNotNull(), F.raise_error(F.lit("lost on purpose")).cast("string"))
    try:
        W.publish(spark, {"dim_listing": listing, "dim_date": dates, "fact_reviews": fact.withColumn("comments", lost)}, root, "2024-09-03")
    except Exception as e:  # noqa: BLE001 - the failure is the point; any other error is raised again
        if "lost on purpose" not in str(e):
            raise
    now = W.resolve(spark, root)
    tables = W.read(spark, root)
    per = tables["fact_reviews"].groupBy("listing_id").agg(F.count(F.lit(1)).alias("reviews"))
    return (tables["dim_listing"].join(per, "listing_id", "left")
            .select("listing_id", "price", "reviews", F.lit(now.number).alias("version"), F.lit(now.ds).alias("ds")))


def _three_days(spark, sf) -> str:
    """Curated tables of three days: a line item's review is staged on the day
    of its line number mod 3.  Day two is staged wrong first (its positive
    reviews only, scores doubled); then that day alone is replaced and updated."""
    root = scratch_path(spark, "curated")
    days = ["2024-09-01", "2024-09-02", "2024-09-03"]
    day = F.element_at(F.array(*[F.lit(d).cast("date") for d in days]), (F.col("l_linenumber") % 3 + 1).cast("int"))
    staged = S.read_table(spark, sf, "lineitem").selectExpr("l_linenumber", *S._LINEITEM_REVIEW_EXPRS).withColumn("ds", day)
    staged = staged.drop("l_linenumber", "review_date")
    each = F.explode(F.array(*[F.lit(d).cast("date") for d in days])).alias("ds")
    wrong = (F.col("ds") != days[1]) | (F.col("sentiment_label") == "POSITIVE")
    doubled = F.when(F.col("ds") == days[1], F.col("sentiment_score") * 2).otherwise(F.col("sentiment_score"))
    CU.write_partition(staged.where(wrong).withColumn("sentiment_score", doubled), f"{root}/fact_reviews")
    CU.write_partition(_listing(spark, sf, city=True).select("*", each), f"{root}/dim_listing")
    CU.write_partition(_review_calendar(spark, sf).select("*", each), f"{root}/dim_date")
    for d in days:
        RU.update_day(spark, root, d)
    CU.write_partition(staged.where(F.col("ds") == days[1]), f"{root}/fact_reviews", days[1])
    RU.update_day(spark, root, days[1])
    return root


@register()
def rollup_listing_sentiment(spark, sf):
    return RU.listing_sentiment(spark, _three_days(spark, sf))


@register()
def rollup_city_sentiment_daily(spark, sf):
    return RU.city_sentiment_daily(spark, _three_days(spark, sf))


@register()
def rollup_distinct_hosts(spark, sf):
    """Hosts (customers) by the order's year, one sketch a year: for every run
    of years the merged estimate's error against the exact count, as a flag."""
    root = scratch_path(spark, "curated")
    years = [r.y for r in S.read_table(spark, sf, "orders").select(F.year("o_orderdate").alias("y")).distinct().orderBy("y").collect()]
    hosts = S.read_table(spark, sf, "orders").select(F.col("o_custkey").alias("host_id"), F.year("o_orderdate").alias("y"))
    for y in years:
        CU.write_partition(RU.host_rollup(hosts.where(F.col("y") == y)), f"{root}/rollup_hosts", f"{y}-01-01")
    out = None
    for y in years:
        near = RU.distinct_hosts(spark, root, f"{years[0]}-01-01", f"{y}-01-01")
        exact = hosts.where(F.col("y") <= y).agg(F.countDistinct("host_id").alias("hosts"))
        row = exact.withColumn("n_hosts", F.lit(near.first().n_hosts)).select(F.lit(y).alias("to_year"), "hosts", (F.abs(F.col("n_hosts") - F.col("hosts")) <= 0.05 * F.col("hosts")).alias("near"))
        out = row if out is None else out.unionByName(row)
    return out


@register()
def quality_report(spark, sf):
    return Q.quality_report(_listing(spark, sf), _review_calendar(spark, sf), _fact(spark, sf))


# ------------------------------------------------------------ the daily job
def _land_raw_day(spark, sf) -> str:
    """One raw drop (listings from ``part``, reviews from ``documents``)."""
    raw = scratch_path(spark, "raw")
    R.write_csv_raw(_raw_listings(spark, sf), f"{raw}/listings", _raw_files(spark))
    R.write_csv_raw(_raw_reviews(spark, sf), f"{raw}/reviews", _raw_files(spark))
    return raw


@register()
def curate_day(spark, sf):
    """Raw CSV -> the three curated tables of one day; their row counts."""
    cur = scratch_path(spark, "curated")
    P.curate_day(spark, _land_raw_day(spark, sf), cur, "2024-09-01")
    return Q.dq_row_counts({t: CU.scan_curated_partition(spark, f"{cur}/{t}", "2024-09-01")
                            for t in ("dim_listing", "dim_date", "fact_reviews_stage")})


@register()
def run_day(spark, sf):
    """Curate, score (offline scorer, every review), gate and publish one day,
    and update its views; the published fact table."""
    cur, wh = scratch_path(spark, "curated"), scratch_path(spark, "warehouse")
    P.run_day(spark, _land_raw_day(spark, sf), cur, wh, "2024-09-01")
    return W.read(spark, wh)["fact_reviews"].select(
        "review_id", "listing_id", "date_key", "tokens_ct", "sentiment_label", "sentiment_score")


# ------------------------------------------------- scalar rules on their own
@register()
def price_bucket(spark, sf):
    return _listing(spark, sf).select("listing_id", "price", "price_bucket")


@register()
def indicator_rate(spark, sf):
    positive = F.col("sentiment_label") == "POSITIVE"
    return _fact(spark, sf).groupBy("date_key").agg(X.indicator_rate(positive).alias("positive_rate"))


@register()
def date_parts(spark, sf):
    o = S.read_table(spark, sf, "orders")
    parts = X.date_parts(F.to_date("o_orderdate"))
    return o.select(F.col("o_orderkey").alias("key"), *[v.alias(k) for k, v in parts.items()])


@register()
def days_since(spark, sf):
    lst = S.listings_from_orders(spark, sf)
    return lst.select("listing_id", X.days_since(F.col("first_review"), "2002-01-01").alias("days"))


@register()
def text_length(spark, sf):
    d = S.read_table(spark, sf, "documents")
    return d.select("doc_id", X.text_length(F.col("text")).alias("n_chars_text"))
