"""Daily activity logs on Spark: ingest, quality reports, cleaning, history features, star schema, models."""
