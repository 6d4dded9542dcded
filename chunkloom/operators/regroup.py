"""Hits regrouped into documents: one row per request and file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_FIELDS = (
    "chunk_id",
    "content",
    "original_span",
    "hierarchy_level",
    "custom_properties",
    "parent_id",
    "embedding",
    "tenant",
    "distance",
    "rank",
    "is_parent",
)
# Where rows lie that were fetched by file: a hash of the file, and the share of requests that meet it there.
HOME, SHARE = "__home", "__share"


def group_by_file(rows: DataFrame, part_chunks: int | None = None) -> DataFrame:
    """Documents holding only their hit chunks, in order of place.

    ``first_place`` orders the documents of a request; metadata is that of the first hit. By default
    each document is one row. For result lists without a bound the caller can give ``part_chunks``:
    every document, whatever its size, then comes in parts of so many hits, numbered by ``part`` of
    ``parts``, each with the place and the metadata of the whole document.

    Rows that lie in the partition of their file (``HOME`` and ``SHARE``, which file and request tell) are
    grouped there.
    """
    keys = ["request_id", "filename", *[c for c in (HOME, SHARE) if c in rows.columns]]
    if part_chunks is None:
        parted = rows.withColumn("part", F.lit(0).cast("bigint"))
    else:
        # hits are numbered within their document by the sort of a window, which spills
        order = Window.partitionBy(*keys).orderBy("place")
        parted = rows.withColumn("part", F.floor((F.row_number().over(order) - 1) / part_chunks).cast("bigint"))
    shaped = parted.withColumn(
        "original_span",
        F.struct(F.col("original_span_start").alias("start"), F.col("original_span_end").alias("end")),
    )
    if "embedding" not in shaped.columns:
        shaped = shaped.withColumn("embedding", F.lit(None).cast("array<float>"))
    chunk = F.struct("place", *CHUNK_FIELDS)
    grouped = shaped.groupBy(*keys, "part").agg(
        F.min("place").alias("first_place"),
        F.min_by("document_metadata", "place").alias("document_metadata"),
        F.collect_list(chunk).alias("chunks"),
    ).drop(HOME, SHARE)
    in_order = F.array_sort(
        "chunks", lambda a, b: F.when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0)
    )
    grouped = grouped.withColumn("chunks", F.transform(in_order, lambda c: c.dropFields("place")))
    if part_chunks is None:
        return grouped.withColumn("parts", F.lit(1).cast("bigint"))
    whole = grouped.groupBy("request_id", "filename").agg(
        F.min("first_place").alias("first_place"),
        F.min_by("document_metadata", "first_place").alias("document_metadata"),
        F.count("*").alias("parts"),
    )
    return grouped.drop("first_place", "document_metadata").join(whole, ["request_id", "filename"])


def documents_json(documents: DataFrame) -> DataFrame:
    """One JSON document per row, in the shape documents are persisted in."""
    span = lambda c: F.array(c["original_span"]["start"], c["original_span"]["end"])
    chunks = F.transform("chunks", lambda c: c.withField("original_span", span(c)))
    body = F.struct("filename", "document_metadata", chunks.alias("chunks"))
    return documents.select("request_id", "first_place", "part", "parts", F.to_json(body).alias("document"))
