"""Log analytics on Spark: intake, parsing, routing, storage, queries and alerts as DataFrame jobs."""
