"""Hierarchy levels: counting from the root, or from the deepest level present."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_level(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.max("hierarchy_level").alias("max_level"))


def at_level(chunks: DataFrame, level: int | None) -> Column | None:
    """Predicate for a level; a negative one counts up from the deepest level of ``chunks``.

    The deepest level is that of the whole collection or tenant given here, before any other
    filter. It is a scalar subquery, so no join is planned; an empty input matches nothing.
    """
    if level is None:
        return None
    if level >= 0:
        return F.col("hierarchy_level") == level
    deepest = chunks.agg((F.max("hierarchy_level") + level + 1).alias("level"))
    return F.col("hierarchy_level") == deepest.scalar()


def chunks_per_level(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("hierarchy_level").agg(
        F.count("*").alias("nr_chunks"), F.countDistinct("filename").alias("nr_files")
    )
