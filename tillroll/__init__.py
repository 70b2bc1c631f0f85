"""Customer value analytics on transaction tables, written for Spark."""
