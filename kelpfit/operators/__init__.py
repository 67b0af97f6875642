"""Fit/transform operators that run as Spark jobs."""
