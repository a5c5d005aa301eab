"""Delivery analytics on Spark: ingest, star schema, reports, delay features and delay model."""
