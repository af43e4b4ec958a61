"""Cloud-spend analytics as Spark DataFrame jobs."""
