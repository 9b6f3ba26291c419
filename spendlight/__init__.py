"""Marketing analytics on Spark: star schema, metrics, marts and reports."""
