"""Readers: raw files, event messages, curated tables, Kafka, and the retail test tables."""
