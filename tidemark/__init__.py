"""Layered batch time series on Spark: land, stamp, check, clean, upsert, summarise."""
