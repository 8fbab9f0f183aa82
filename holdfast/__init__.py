"""Customer retention analytics as Spark jobs."""
