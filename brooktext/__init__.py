"""Streaming text classification written as Spark jobs."""
