"""Chunk search and maintenance on Spark: collections of hierarchical text chunks as tables."""
