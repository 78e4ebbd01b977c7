"""meterlake: bronze-to-silver ingestion and reports for utility meter and
billing data, written as plain Spark DataFrame jobs.

Sub-packages
------------
functions   column expressions (coercion, identifiers, tariffs, bands)
sources     scans: bronze text trees, silver parquet, file inventories, logs
operators   DataFrame -> DataFrame transforms (cleaning, dedup, reports,
            data quality, billing, log search)
plans       end-to-end jobs: full / incremental / append load, export
streaming   Structured Streaming ingestion of new bronze files
"""

__version__ = "0.1.0"
