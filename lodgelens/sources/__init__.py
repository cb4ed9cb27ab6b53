"""Sources and sinks: raw CSV, day-partitioned curated Parquet, warehouse snapshots,
and the stand-in mapping of the test tables."""
