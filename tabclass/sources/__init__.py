"""Sources and sinks: CSV / Parquet files, the dataset catalog, metrics store."""
