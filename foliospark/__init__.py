"""Document-processing analytics expressed as Spark DataFrame operations."""
