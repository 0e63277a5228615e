"""Sources and sinks: parquet/CSV/text scans, panel and text adapters."""
