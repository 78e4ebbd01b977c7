"""Scans: bronze text trees, file inventories, silver Parquet, logs, dimensions."""
