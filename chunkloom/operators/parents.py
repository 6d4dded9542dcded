"""Parents of hits: added after their first child, or put in its place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.operators.regroup import CHUNK_FIELDS, HOME, SHARE
from chunkloom.operators.requests import BatchProfile, row_bytes
from chunkloom.operators.storage import materialize

BROADCAST_HITS = 200_000
BROADCAST_CHUNKS = 64 << 20  # bytes of narrow chunks that unbounded hits are joined with where they are
FILE_HITS = 100_000  # hits of one file that meet it in one task
_STORED = ("filename", "document_metadata", "original_span_start", "original_span_end", "embeddings", *CHUNK_FIELDS)


def beside_requests(rows: DataFrame, params: DataFrame, batch: BatchProfile) -> DataFrame:
    """Join request parameters to hits; the requests are broadcast only when known to be small."""
    return rows.join(F.broadcast(params) if batch.is_small else params, "request_id")


def apply_parent_strategy(hits: DataFrame, requests: DataFrame, batch: BatchProfile) -> DataFrame:
    """Result rows in order of ``place``: hits, their parents, or both, as each request asks.

    A parent comes once per request, at its first child (``replace``) or right after it
    (``include``); a parent that is a hit itself keeps its own place too. Only ids move here: the
    chunks themselves are fetched once, later.
    """
    if not batch.with_parents:
        return hits.select(
            "request_id", "tenant", "chunk_id", "distance", "rank",
            (F.col("rank") * 2).alias("place"), F.lit(False).alias("is_parent"),
        )
    asked = beside_requests(hits, requests.select("request_id", "parent_strategy"), batch)
    strategy = F.col("parent_strategy")
    # both from one row, so that the hits are not computed once for each
    own = F.when(strategy.isNull() | (strategy != "replace"), _result("chunk_id", False))
    parent = F.when(strategy.isNotNull() & F.col("parent_id").isNotNull(), _result("parent_id", True))
    return (
        asked.select(
            "request_id", "tenant", "distance", "rank",
            F.explode(F.array_compact(F.array(own, parent))).alias("result"),
        )
        .groupBy("request_id", "tenant", "result.chunk_id", "result.is_parent")
        .agg(F.min("rank").alias("rank"), F.min_by("distance", "rank").alias("distance"))
        .withColumn("place", F.col("rank") * 2 + F.col("is_parent").cast("bigint"))
    )


def _result(chunk_id: str, is_parent: bool) -> Column:
    return F.struct(F.col(chunk_id).alias("chunk_id"), F.lit(is_parent).alias("is_parent"))


def fetch_chunks(rows: DataFrame, chunks: DataFrame, batch: BatchProfile, narrow: bool = False) -> DataFrame:
    """The chunks behind result rows; a parent that is not stored is dropped.

    Result rows are broadcast when requests x top bounds them, so the chunks are not shuffled. Where nothing
    bounds them and the chunks are ``narrow``, without their contents, these are broadcast up to a measured
    size: rows that may be a share of all pairs are then not sent to be joined.
    """
    ids = ["tenant", "chunk_id"]
    if narrow and batch.max_hits is None:
        chunks = materialize(chunks)
        size = chunks.agg(F.sum(row_bytes(chunks))).first()[0] or 0
        return (F.broadcast(chunks) if size <= BROADCAST_CHUNKS else chunks).join(rows, ids)
    bounded = batch.max_hits is not None and 2 * batch.max_hits <= BROADCAST_HITS
    keys = F.broadcast(rows) if bounded else rows
    return chunks.join(keys, ids)


def fetch_by_file(rows: DataFrame, chunks: DataFrame, batch: BatchProfile) -> DataFrame:
    """Like ``fetch_chunks`` for rows that are then grouped by file, with what grouping needs.

    Hits and chunks meet in the partition of their file, where the documents are made too, so a content is
    sent once, not with each of its hits. A file of very many hits is sent to several partitions, each
    with a share of the requests.
    """
    if batch.max_hits is not None and 2 * batch.max_hits <= BROADCAST_HITS:
        return fetch_chunks(rows, chunks, batch)
    ids = ["tenant", "chunk_id"]
    stored = chunks.select(*[c for c in chunks.columns if c in _STORED]).withColumn(HOME, F.xxhash64("filename"))
    homes = stored.groupBy(*ids).agg(F.collect_set(HOME).alias(HOME))
    keys = materialize(rows.join(homes, ids).withColumn(HOME, F.explode(HOME)))
    crowded = F.broadcast(
        keys.groupBy(HOME).agg(F.ceil(F.count("*") / FILE_HITS).alias("shares")).where("shares > 1")
    )
    shares = F.coalesce("shares", F.lit(1))
    hits = keys.join(crowded, HOME, "left").select(
        HOME, F.pmod(F.xxhash64("request_id"), shares).alias(SHARE), *ids, F.lit(1).alias("kind"),
        F.struct(*[c for c in rows.columns if c not in ids]).alias("hit"),
    )
    contents = stored.join(crowded, HOME, "left").select(
        HOME, F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1)).alias(SHARE), *ids, F.lit(0).alias("kind"),
        F.struct(*[c for c in stored.columns if c not in (*ids, HOME)]).alias("stored"),
    )
    partitions = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = contents.unionByName(hits, allowMissingColumns=True).repartition(partitions, HOME, SHARE)
    # chunks come first; an id that is stored twice is found twice
    before = Window.partitionBy(HOME, SHARE, *ids).orderBy("kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = met.withColumn("stored", F.collect_list("stored").over(before)).where("kind = 1")
    return found.withColumn("stored", F.explode("stored")).select(HOME, SHARE, *ids, "stored.*", "hit.*")
