"""Canonical schemas of a collection, a document feed and a table of search requests."""

from __future__ import annotations

from pyspark.sql import types as T

DEFAULT_TENANT = "__default__"
DEFAULT_VECTOR = "default"
BUCKET = "id_bucket"

# The five fixed properties of a chunk, and the type names a declared
# property may use.
FIXED_PROPERTIES = {
    "filename": "STRING",
    "content": "STRING",
    "original_span_start": "BIGINT",
    "original_span_end": "BIGINT",
    "hierarchy_level": "INT",
}
PROPERTY_TYPES = {
    "text": "STRING",
    "int": "BIGINT",
    "number": "DOUBLE",
    "boolean": "BOOLEAN",
    "bool": "BOOLEAN",
    "date": "TIMESTAMP",
    "uuid": "STRING",
    "object": "VARIANT",
}
METHODS = ("cosine", "dot", "l2-squared", "hamming", "manhattan")


def property_ddl(type_name: str) -> str:
    """Spark type of a declared property; ``<type>_array`` is an array of that type."""
    name = type_name.lower()
    if name.endswith("_array"):
        return f"ARRAY<{property_ddl(name[: -len('_array')])}>"
    if name not in PROPERTY_TYPES:
        raise ValueError(f"unknown property type '{type_name}'")
    return PROPERTY_TYPES[name]


def collection_columns(
    metadata_type: str = "VARIANT",
    custom_type: str = "VARIANT",
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Column name -> DDL type of a collection table, the two partition columns last."""
    columns = {"chunk_id": "STRING", **FIXED_PROPERTIES, "parent_id": "STRING"}
    columns["document_metadata"] = metadata_type
    columns["custom_properties"] = custom_type
    columns["embeddings"] = "MAP<STRING, ARRAY<FLOAT>>"
    for name, type_name in (properties or {}).items():
        if name in columns or name in ("tenant", BUCKET):
            raise ValueError(f"property '{name}' clashes with a fixed column")
        columns[name] = property_ddl(type_name)
    columns["tenant"] = "STRING"
    columns[BUCKET] = "INT"
    return columns


def document_schema(metadata_type: str = "VARIANT", custom_type: str = "VARIANT") -> str:
    """DDL of one document message; ``original_span`` is a two-element array as in the JSON."""
    return (
        f"filename STRING, document_metadata {metadata_type}, chunks ARRAY<STRUCT<"
        "chunk_id: STRING, content: STRING, original_span: ARRAY<BIGINT>, "
        f"hierarchy_level: INT, parent_id: STRING, custom_properties: {custom_type}, "
        "embedding: ARRAY<FLOAT>>>"
    )


REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("collection_name", T.StringType()),
        T.StructField("tenant_name", T.StringType()),
        T.StructField("vector_name", T.StringType()),
        T.StructField("query_text", T.StringType()),
        T.StructField("query_embedding", T.ArrayType(T.FloatType())),
        T.StructField("method", T.StringType()),
        T.StructField("parent_strategy", T.StringType()),
        T.StructField("top", T.IntegerType()),
        T.StructField("horizon", T.DoubleType()),
        T.StructField("auto_limit", T.IntegerType()),
        T.StructField("alpha", T.DoubleType()),
        T.StructField("operation_level", T.IntegerType()),
        T.StructField("include_vector", T.BooleanType()),
        T.StructField("having_all", T.StringType()),
        T.StructField("having_any", T.StringType()),
    ]
)
