"""Continuous ingest: document messages upserted into a collection as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chunkloom.operators.ingest import Embedder
from chunkloom.schema import document_schema
from chunkloom.sources.catalog import persist_documents


def stream_documents(
    spark: SparkSession, path: str, metadata_type: str = "VARIANT", custom_type: str = "VARIANT"
) -> DataFrame:
    """New JSON files of a folder as a stream of documents."""
    return spark.readStream.schema(document_schema(metadata_type, custom_type)).json(path)


def ingest(
    documents: DataFrame,
    collection: str,
    checkpoint: str,
    tenant: str | None = None,
    vector_name: str | None = None,
    embed: Embedder | None = None,
    **trigger,
) -> StreamingQuery:
    """Upsert every micro-batch once: the collection remembers the last batch of the stream.

    A batch that is played again after a crash changes nothing. A stream that starts anew, as after a
    lost checkpoint, is another one and writes the same rows under the same ids. With ``embed``, chunks
    that come without a vector are stored with one.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = (spark.sparkContext.getLocalProperty("sql.streaming.queryId"), number)
        persist_documents(spark, collection, batch, tenant, vector_name, embed=embed, stream=stream)

    writer = documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
