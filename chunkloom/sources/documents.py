"""Reading document messages and search requests, and writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunkloom.operators.regroup import documents_json
from chunkloom.schema import REQUEST_SCHEMA, document_schema


def read_documents(
    spark: SparkSession, path: str, metadata_type: str = "VARIANT", custom_type: str = "VARIANT"
) -> DataFrame:
    """Documents as JSON lines, one per line, under a fixed schema."""
    return spark.read.schema(document_schema(metadata_type, custom_type)).json(path)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Search requests as JSON lines; ``having_*`` objects arrive as JSON text."""
    return spark.read.schema(REQUEST_SCHEMA).json(path)


def write_results(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Result documents as JSON text with their request."""
    documents_json(documents).write.mode(mode).json(path)
