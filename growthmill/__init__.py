"""Marketing and growth analytics as Spark DataFrame operations."""
