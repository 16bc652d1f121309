"""Monthly on-time and reliability analytics as ordinary Spark jobs."""
