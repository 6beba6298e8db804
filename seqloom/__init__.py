"""Sequence analytics on Spark."""
