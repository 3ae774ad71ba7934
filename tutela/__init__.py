"""Student-success analytics as Spark DataFrame jobs."""
