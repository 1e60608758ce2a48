"""Entity-statement analytics as Spark jobs."""
