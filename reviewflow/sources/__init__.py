"""Sources and sinks: JSON lines, Parquet, incremental file ingest, request bodies."""
