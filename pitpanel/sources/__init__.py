"""Sources and sinks: wide price CSV, pipe-delimited fundamentals, matching
CSV, parquet folders, the item-partitioned table and the writers."""
