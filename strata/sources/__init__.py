"""Readers and writers: Kafka options and encoding, JSON lines, Parquet, tables."""
