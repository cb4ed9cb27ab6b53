"""Sentiment from a table of word weights that labelled rows teach.

``learn_weights`` counts in how many positive and negative texts a word stands
and gives its smoothed log-odds in thousandths, as a whole number, so that sums
do not depend on their order.  The empty word carries the odds of the labels
themselves.  ``score_texts`` joins the words of texts with such a table.

Words are runs of a-z of the lower-cased text, each counted once a text.  A
null or empty text, or one without known words, is judged by the empty word.
Equal texts get equal scores: what is joined and summed is keyed by a digest
of the text, so copies melt together map-side, however many there are, and no
text is shuffled to be scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelens.operators.scoring import LEXICON_TOKEN_PATTERN

SCHEMA = "token string, n_pos long, n_neg long, weight long"


def distinct_words(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), LEXICON_TOKEN_PATTERN)), "")


def learn_weights(labelled: DataFrame, text_col: str, positive: Column, min_texts: int = 3, least: int = 100) -> DataFrame:
    """(token, n_pos, n_neg, weight) from all ``labelled`` rows whose label is not null.

    Words of fewer than ``min_texts`` texts, or with a weight nearer to 0 than
    ``least`` thousandths, say too little and are left out; so the common words
    that stand in every text never reach the join.
    """
    rows = labelled.select(positive.alias("good"), F.col(text_col).alias("text")).where("good is not null")
    total = rows.agg(F.count_if("good").alias("p"), F.count_if(~F.col("good")).alias("n")).first()  # two numbers
    p, n = total["p"], total["n"]
    odds = F.floor(1000 * F.log(((F.col("n_pos") + 1) * F.lit(n + 2)).cast("double") / ((F.col("n_neg") + 1) * F.lit(p + 2)).cast("double")))
    words = (rows.select("good", F.explode(distinct_words(F.col("text"))).alias("token"))
             .groupBy("token").agg(F.count_if("good").alias("n_pos"), F.count_if(~F.col("good")).alias("n_neg"))
             .where(F.col("n_pos") + F.col("n_neg") >= min_texts)
             .withColumn("weight", odds.cast("long")).where(F.abs("weight") >= least))
    prior = labelled.sparkSession.range(1).select(
        F.lit("").alias("token"), F.lit(p).cast("long").alias("n_pos"), F.lit(n).cast("long").alias("n_neg"),
        F.floor(1000 * F.log(F.lit(float(p + 1)) / F.lit(float(n + 1)))).cast("long").alias("weight"))
    return words.unionByName(prior)


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def score_texts(df: DataFrame, weights: DataFrame, text_col: str = "comments") -> DataFrame:
    """``df`` with sentiment_label, sentiment_score (0.5 to 1, the nearer to 1 the clearer) and evidence (long).

    Above 0 the evidence is for POSITIVE.  Columns of these names are replaced.
    """
    prior = weights.where("token = ''").agg(F.coalesce(F.max("weight"), F.lit(0)).alias("w")).first()["w"]
    texts = df.select(text_digest(F.col(text_col)).alias("_digest"), F.col(text_col).alias("text"))
    # every copy of a text adds the same, so its sum over the number of copies is its own
    copies = texts.groupBy("_digest").agg(F.count("*").alias("n"))
    sums = (texts.select("_digest", F.explode(distinct_words(F.col("text"))).alias("token"))
            .join(weights.where("token != ''").select("token", "weight"), "token")
            .groupBy("_digest").agg(F.sum("weight").alias("s")))
    found = copies.join(sums, "_digest", "left").select("_digest", F.expr("coalesce(s div n, 0L)").alias("_sum"))
    evidence = F.col("_sum") + F.lit(prior)
    size = F.abs("evidence")
    return (df.drop("sentiment_label", "sentiment_score", "evidence").withColumn("_digest", text_digest(F.col(text_col)))
            .join(found, "_digest").withColumn("evidence", evidence)
            .withColumns({"sentiment_label": F.when(F.col("evidence") > 0, "POSITIVE").otherwise("NEGATIVE"),
                          "sentiment_score": (size + 1000).cast("double") / (size + 2000).cast("double")})
            .drop("_digest", "_sum"))
