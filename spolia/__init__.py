"""Text-reuse corpus preparation and alignment statistics as Spark jobs."""
