"""Sources and sinks: parquet tables, CSV / JSON files, snapshot sinks."""
