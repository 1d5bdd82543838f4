"""CSV ingest, snapshot-partitioned Parquet, and the shared scratch folder."""
