"""Customer retention and sales quota analytics as Spark DataFrame operations."""
