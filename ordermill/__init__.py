"""Nested order events with Spark DataFrames."""
