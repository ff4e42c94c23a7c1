"""Partitioned Parquet tables: upserts, reads, maintenance."""
