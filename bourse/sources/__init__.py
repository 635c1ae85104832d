"""Readers and writers: landing JSON, published Parquet, CSV calendars, model tables."""
