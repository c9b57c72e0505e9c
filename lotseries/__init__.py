"""Field-level satellite time-series analytics as Spark DataFrame operations."""
