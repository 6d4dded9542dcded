"""Upsert and delete as pure transforms: tables in, resulting rows and counts out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.errors import InvalidFilter
from chunkloom.operators.predicates import compile_filter

KEYS = ["tenant", "chunk_id"]
BROADCAST_KEYS = 500_000  # ids of at most this many rows may be sent to every task


def last_of_each(batch: DataFrame, order_by: tuple[str, ...] = ("hierarchy_level", "position")) -> DataFrame:
    """One row per (tenant, chunk_id): the last by level, then by input order.

    An aggregate with partial results before the shuffle, so that many copies of one id never
    meet in one task. Columns of ``order_by`` that the batch lacks are skipped; full ties are
    settled by the content.
    """
    keys = [k for k in KEYS if k in batch.columns]
    order = [c for c in order_by if c in batch.columns] + ["content", "filename"]
    row = F.struct(*[F.col(c) for c in batch.columns])
    kept = batch.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("row"))
    return kept.select("row.*")


def upsert(
    target: DataFrame, batch: DataFrame, row_bound: int | None = None, replace: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows after writing ``batch`` into ``target``, and ``nr_inserts, nr_replaces``.

    An existing id is replaced as a whole, vectors included. Without ``replace`` an existing id
    raises when the counts or rows are read. ``row_bound`` is a known upper bound on the rows of
    the batch.
    """
    incoming = last_of_each(batch)
    counts = upsert_counts(target, incoming)
    if not replace:
        clash = F.raise_error(F.lit("chunk ids exist already and replacing is off")).cast("bigint")
        counts = counts.withColumn(
            "nr_replaces", F.when(F.col("nr_replaces") > 0, clash).otherwise(F.col("nr_replaces"))
        )
    return replace_rows(target, incoming, row_bound), counts


def replace_rows(target: DataFrame, incoming: DataFrame, row_bound: int | None = None) -> DataFrame:
    """Stored rows whose id is not incoming, and the (deduplicated) incoming rows."""
    kept = kept_rows(target, incoming, row_bound)
    written = incoming.select(*[c for c in target.columns if c in incoming.columns])
    return kept.unionByName(written, allowMissingColumns=True).select(*target.columns)


def kept_rows(target: DataFrame, incoming: DataFrame, row_bound: int | None = None) -> DataFrame:
    """Stored rows whose id is not incoming.

    Only the ids of the incoming rows meet the stored rows: broadcast with a small known bound,
    otherwise as Spark finds their size to be, so that a small batch never shuffles stored contents.
    """
    return target.join(bounded_ids(incoming, KEYS, row_bound), KEYS, "left_anti")


def bounded_ids(rows: DataFrame, keys: list[str], row_bound: int | None) -> DataFrame:
    ids = rows.select(*keys)
    return F.broadcast(ids) if row_bound is not None and row_bound <= BROADCAST_KEYS else ids


def upsert_counts(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """``nr_inserts, nr_replaces`` of deduplicated rows; only key columns are read."""
    stored = target.select(*KEYS).withColumn("stored", F.lit(True))
    joined = incoming.select(*KEYS).join(stored, KEYS, "left")
    return joined.agg(
        F.count_if(F.col("stored").isNull()).alias("nr_inserts"),
        F.count_if(F.col("stored").isNotNull()).alias("nr_replaces"),
    )


def delete_counts(matched: DataFrame) -> DataFrame:
    """``matches, failed, successful``; a job commits whole or raises, so nothing half-fails."""
    return matched.agg(
        F.count("*").alias("matches"),
        F.lit(0).cast("bigint").alias("failed"),
        F.count("*").alias("successful"),
    )


def split_where(target: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that stay, and rows for which ``predicate`` is true."""
    gone = F.coalesce(predicate, F.lit(False))
    return target.where(~gone), target.where(predicate)


def split_ids(
    target: DataFrame, ids: DataFrame, row_bound: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that stay, and rows whose id is in ``ids`` (``chunk_id``, and ``tenant`` if present)."""
    keys = [k for k in KEYS if k in ids.columns]
    wanted = ids.select(*keys).distinct()
    if row_bound is not None and row_bound <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    return target.join(wanted, keys, "left_anti"), target.join(wanted, keys, "left_semi")


def document_ids(documents: DataFrame) -> DataFrame:
    tenant = ["tenant"] if "tenant" in documents.columns else []
    return documents.select(*tenant, F.explode("chunks.chunk_id").alias("chunk_id"))


def filter_predicate(schema: T.StructType, having_all=None, having_any=None) -> Column:
    """The predicate of a delete; without any filter nothing may be deleted."""
    predicate = compile_filter(schema, having_all, having_any)
    if predicate is None:
        raise InvalidFilter("a delete needs a filter")
    return predicate


def _counted(split: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    kept, matched = split
    return kept, delete_counts(matched)


def delete_by_ids(
    target: DataFrame, ids: DataFrame, row_bound: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows left after deleting a table of ids, and the counts. Children of a chunk stay."""
    return _counted(split_ids(target, ids, row_bound))


def delete_by_id(target: DataFrame, ids: list[str]) -> tuple[DataFrame, DataFrame]:
    """Delete a list of ids given by the caller."""
    return _counted(split_where(target, F.col("chunk_id").isin(ids)))


def delete_by_filename(target: DataFrame, filename: str) -> tuple[DataFrame, DataFrame]:
    return _counted(split_where(target, F.col("filename") == filename))


def delete_document(
    target: DataFrame, documents: DataFrame, row_bound: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Delete the chunks listed in documents, whatever their filename."""
    return _counted(split_ids(target, document_ids(documents), row_bound))


def delete_by_filter(
    target: DataFrame, having_all=None, having_any=None
) -> tuple[DataFrame, DataFrame]:
    return _counted(split_where(target, filter_predicate(target.schema, having_all, having_any)))
