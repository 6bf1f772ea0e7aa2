"""Product-catalogue analytics as Spark jobs."""
