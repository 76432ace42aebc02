"""Transaction reads (CSV / parquet / star-schema test tables), assignments, result sinks."""
