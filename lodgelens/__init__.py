"""lodgelens: a Spark-native listings and reviews analytics mart.

Layout
------
functions/  pure ``Column -> Column`` expressions (parsing, bucketing, rounding)
sources/    raw CSV scan, load ledger, curated partitions, versioned warehouse, stand-ins
operators/  curation, analyses, views kept by day, quality gates, sampling, scoring, reply ledger
plans/      the daily job (curate -> score -> publish) and the query catalog

Every operator takes and returns DataFrames; nothing is collected to the
driver except scalars such as a resolved partition date.
"""

__all__ = ["functions", "sources", "operators", "plans"]
