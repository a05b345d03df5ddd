"""Retail sales mart on Spark: daily ingestion, star-model upserts, data quality and profiling."""
