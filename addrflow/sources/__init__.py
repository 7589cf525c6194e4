"""Sources and sinks: parquet tables, CSV lookups, JDBC queries and appends."""
