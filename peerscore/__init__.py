"""Find places that outperform their peers, as Spark jobs."""
