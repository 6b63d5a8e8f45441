"""Flow-record security analytics as PySpark DataFrame, MLlib and Structured Streaming jobs."""
