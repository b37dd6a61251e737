"""Readers: XML feeds, archives, station JSON and Parquet tables."""
