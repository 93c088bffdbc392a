"""Operators and queries for large training-data pipelines.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when it is there.
"""
