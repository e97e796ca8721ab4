"""Readers and writers: CSV, JDBC, parquet, JSON messages, Kafka options."""
