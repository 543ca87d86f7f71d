"""Whole runs: the pipeline, and the registered queries with their oracle SQL."""
