"""Document-embedding analytics on Spark."""
