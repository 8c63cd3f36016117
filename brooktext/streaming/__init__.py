"""Micro-batch training, scoring and counting on Structured Streaming."""
