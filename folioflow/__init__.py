"""Electronic tax documents on Spark: ingest, data quality, enrichment, curated views, reports."""
