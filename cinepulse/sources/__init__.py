"""Sources and sinks: topic, message files, the Parquet lake, the snapshot table, adapters and fixtures."""
