"""A collection of chunks and search requests derived from the shared test tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def _tenant_of(file_no: Column) -> Column:
    return F.concat(F.lit("tenant_"), (file_no % 3).cast("string"))


def _of(rows: DataFrame, number: str, tenant: str | None) -> DataFrame:
    """Rows of one tenant, told by the number of their file, which is also that of its root."""
    return rows if tenant is None else rows.where(_tenant_of(F.expr(f"{number} DIV 10")) == tenant)


def chunks(spark: SparkSession, folder: str, tenant: str | None = None, graded: bool = False) -> DataFrame:
    """All documents and embeddings as chunks: ten to a file, three levels, three tenants.

    A chunk carries the metadata of its file's root chunk. A document without an embedding is a
    chunk without vectors, and an embedding without a document a chunk without content. With ``tenant``
    only its chunks are made, and with ``graded`` only those with a quality label; other texts are not shuffled.
    """
    documents = _of(table(spark, folder, "documents"), "doc_id", tenant)
    embeddings = _of(table(spark, folder, "embeddings"), "vec_id", tenant)
    labels = _of(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", tenant)
    texts, vectors = documents.select("doc_id", "text", "n_chars"), embeddings.withColumnRenamed("vec_id", "doc_id")
    if graded:
        ids = labels.where("quality IS NOT NULL").select("doc_id")
        texts, vectors = (rows.join(ids, "doc_id", "left_semi") for rows in (texts, vectors))
    stored = (
        texts.join(vectors, "doc_id", "full")
        .join(labels, "doc_id", "left")
    )
    if graded:
        stored = stored.where("quality IS NOT NULL")
    number = F.col("doc_id")
    file_no, place = F.expr("doc_id DIV 10"), number % 10
    # one row of metadata for each id that a root can have below it, so that texts move by one key only
    below = F.transform(F.sequence(F.lit(-9), F.lit(9)), lambda step: F.try_add(number, step.cast("bigint")))
    root = documents.where(number % 10 == 0).select(
        F.explode(below).alias("doc_id"), number.alias("root_id"),
        F.col("lang").alias("md_language"), F.col("source").alias("md_source"),
    )
    root = root.where(number - place == F.col("root_id")).drop("root_id")
    parent = (
        F.when(place == 0, None)
        .when(place <= 3, number - place)
        .otherwise(number - place + 1 + place % 3)
    )
    vectors = F.when(
        F.col("embedding").isNotNull(),
        F.create_map(
            F.lit("default"), "embedding",
            F.lit("low_space"), F.slice("embedding", 1, 8),
            F.lit("signs"), F.transform("embedding", lambda x: F.when(x > 0, 1.0).otherwise(0.0).cast("float")),
        ),
    )
    return stored.join(root, "doc_id", "left").select(
        number.cast("string").alias("chunk_id"),
        F.concat(F.lit("doc_"), file_no.cast("string"), F.lit(".txt")).alias("filename"),
        F.col("text").alias("content"),
        F.lit(0).cast("bigint").alias("original_span_start"),
        F.col("n_chars").alias("original_span_end"),
        F.when(place == 0, 0).when(place <= 3, 1).otherwise(2).alias("hierarchy_level"),
        parent.cast("string").alias("parent_id"),
        F.struct(F.col("md_language").alias("language"), F.col("md_source").alias("source")).alias(
            "document_metadata"
        ),
        F.struct(
            F.col("label").alias("label"),
            F.col("quality").alias("quality"),
            F.split("md_source", "c").alias("tags"),
        ).alias("custom_properties"),
        vectors.alias("embeddings"),
        _tenant_of(file_no).alias("tenant"),
    )


def vector_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding as a search request; ``label`` is left for per-request parameters."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("request_id"),
        F.col("embedding").alias("query_embedding"),
        "label",
    )


def text_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item as a text request, over its whole text."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").cast("string").alias("request_id"), F.col("text").alias("query_text")
    )


def documents(spark: SparkSession, folder: str, tenant: str | None = None) -> DataFrame:
    """The chunks nested back into documents, ten chunks to a document; all, or those of one tenant."""
    stored = chunks(spark, folder, tenant)
    chunk = F.struct(
        "chunk_id",
        "content",
        F.array("original_span_start", "original_span_end").alias("original_span"),
        "hierarchy_level",
        "parent_id",
        "custom_properties",
        F.try_element_at("embeddings", F.lit("default")).alias("embedding"),
    )
    return stored.groupBy("tenant", "filename").agg(
        F.first("document_metadata").alias("document_metadata"),
        F.collect_list(chunk).alias("chunks"),
    )


def upsert_batch(spark: SparkSession, folder: str, tenant: str | None = None) -> DataFrame:
    """New versions of every chunk with a quality label, and every conversation turn; all, or one tenant's.

    The turns of a conversation share one id, so that only its last turn is kept.
    """
    revised = (
        chunks(spark, folder, tenant, graded=True)
        .withColumn("content", F.concat(F.lit("revised "), "content"))
        .withColumn("embeddings", F.lit(None).cast("map<string,array<float>>"))
        .withColumn("position", F.lit(0).cast("bigint"))
    )
    turns = table(spark, folder, "conversations").select(
        F.concat(F.lit("talk_"), F.col("conv_id").cast("string")).alias("chunk_id"),
        F.concat(F.lit("talk_"), F.col("conv_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.col("text").alias("content"),
        F.lit(0).alias("hierarchy_level"),
        F.col("turn").alias("position"),
        _tenant_of(F.col("conv_id")).alias("tenant"),
    )
    turns = turns if tenant is None else turns.where(F.col("tenant") == tenant)
    return revised.unionByName(turns, allowMissingColumns=True)
