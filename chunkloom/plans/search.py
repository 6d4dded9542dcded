"""Searches: a table of requests against a table of chunks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.distance import distance, pick_vector
from chunkloom.functions.text import hashed_term_vector, tokens
from chunkloom.operators import hybrid
from chunkloom.operators.filters_by_request import by_filters, predicate
from chunkloom.operators.ingest import Embedder
from chunkloom.operators.parents import apply_parent_strategy, beside_requests, fetch_by_file, fetch_chunks
from chunkloom.operators.ranking import WINDOW_TOP, auto_cut, auto_cut_all, auto_cut_first, rank_all, top_k
from chunkloom.operators.regroup import group_by_file
from chunkloom.operators.requests import BatchProfile, profile, settle, settle_costly, with_defaults
from chunkloom.operators.scoring import listed_groups, scan, scan_cut, scan_listed, spreads
from chunkloom.operators.storage import materialize
from chunkloom.sources.catalog import scan_collection, stored_counts, stored_postings

LISTED_TERMS = 2_000
FIRST_TOP = 64
TOP_STEP = 4
LONGEST_CUT = 1 << 20  # hits of a request that a task looks at for its cut
Fetch = Callable[[DataFrame, BatchProfile], DataFrame]
_IDS = ("tenant", "chunk_id", "parent_id")
_ASKED = ("request_id", "query_embedding", "slot", "method", "top", "auto_limit", "horizon", "spec")


def _slots(requests: DataFrame, batch: BatchProfile) -> DataFrame:
    """Number the named vectors of the batch; each becomes one column of the scan."""
    slot = reduce(
        lambda acc, pair: acc.when(F.col("vector_name") == pair[1], pair[0]),
        list(enumerate(batch.vector_names))[1:],
        F.when(F.col("vector_name") == batch.vector_names[0], 0),
    )
    return requests.withColumn("slot", slot)


def _vector_columns(batch: BatchProfile) -> list[Column]:
    return [
        pick_vector(F.col("embeddings"), F.lit(name)).alias(f"v{i}")
        for i, name in enumerate(batch.vector_names)
    ]


def _vector_scans(
    chunks: DataFrame, requests: DataFrame, batch: BatchProfile, also: tuple[str, ...] = ()
) -> list[tuple[DataFrame, DataFrame]]:
    """What ``by_filters`` gives, with only the chunks that have a vector the batch searches: no other can be a hit.

    ``also`` names columns of the requests that are no parameters.
    """
    columns = [*[F.col(c) for c in _IDS], *_vector_columns(batch)]
    searched = reduce(Column.__or__, [F.col(f"v{i}").isNotNull() for i in range(len(batch.vector_names))])
    return [
        (kept.where(searched), numbered.select(*_ASKED, *also))
        for kept, numbered in by_filters(chunks, _slots(requests, batch), columns)
    ]


def nearest(
    chunks: DataFrame, requests: DataFrame, batch: BatchProfile, in_tiles: bool = False
) -> DataFrame:
    """Unranked hits of completed requests: filter, then exact scan."""
    if batch.count == 0:
        return scan(
            chunks.limit(0).select(*_IDS, F.lit(None).cast("array<float>").alias("v0")),
            requests.withColumn("slot", F.lit(0)).withColumn("spec", F.lit(0)).select(*_ASKED),
            batch,
        )
    parts = [scan(kept, numbered, batch, in_tiles) for kept, numbered in _vector_scans(chunks, requests, batch)]
    return reduce(DataFrame.unionByName, parts)


def ranked(hits: DataFrame, batch: BatchProfile) -> DataFrame:
    """Hits with their ``rank``, cut to each request's ``top`` and ``auto_limit``."""
    if batch.top is not None and batch.top <= WINDOW_TOP:
        best = top_k(hits, batch.top, from_all_tasks=batch.is_shared)
        return auto_cut(best) if batch.auto_limit else best
    listed = rank_all(hits)
    return auto_cut_all(listed, batch.auto_limit) if batch.auto_limit else listed


def nearest_ranked(
    chunks: DataFrame, asked: DataFrame, batch: BatchProfile, in_tiles: bool = False
) -> DataFrame:
    """The final hits of completed requests, with their ``rank``.

    Requests with an ``auto_limit`` but no ``top`` need few of their hits, though how many only the hits
    tell: they are cut step by step, apart from the others.
    """
    if batch.top is None and batch.limited_hits == 0 and not batch.auto_limit and batch.count and not in_tiles:
        listed = _listed(chunks, asked.where("top IS NULL AND request_id IS NOT NULL"), batch)
        if listed is not None:
            return listed
    if batch.top is not None or not batch.auto_limit or batch.auto_limit <= 0:
        return ranked(nearest(chunks, asked, batch, in_tiles), batch)
    without_top = F.col("top").isNull() & F.coalesce(F.col("auto_limit") > 0, F.lit(False))
    parts, left = _cut_in_steps(chunks, asked.where(without_top), batch)
    for others in (asked.where(~without_top), left):
        its = profile(others)
        if its.count or not parts:
            parts.append(ranked(nearest(chunks, others, its, in_tiles), its))
    columns = parts[0].columns
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def _listed(chunks: DataFrame, asked: DataFrame, batch: BatchProfile) -> DataFrame | None:
    """Unbounded lists of many requests, ranked where they are scored; None if they must be sorted by Spark.

    One pass counts the hits, so that a task gets no more lists than it can hold. The hits themselves, which
    may be a share of all pairs, are then sent nowhere to be ranked.
    """
    scans = _vector_scans(chunks, asked, batch)
    if len(scans) != 1:
        return None
    ((kept, numbered),) = scans
    told = spreads(kept, numbered, batch).agg(F.sum("total").alias("total"), F.max("total").alias("longest")).first()
    partitions = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = listed_groups(batch, kept.count(), told["total"] or 0, told["longest"] or 0, partitions)
    return None if groups is None else scan_listed(kept, numbered, batch, groups)


def _cut_in_steps(
    chunks: DataFrame, asked: DataFrame, batch: BatchProfile
) -> tuple[list[DataFrame], DataFrame]:
    """Hits before the cut, and the requests whose cut lies behind ``WINDOW_TOP`` (in a task, ``LONGEST_CUT``) hits.

    One pass counts and measures all hits of a request where they are scored. Then its nearest hits are
    looked at, more of them in each step, until they hold the start of the group that is not wanted. Those of
    a large batch are looked at in the tasks that score them.
    """
    measured = reduce(
        DataFrame.unionByName, [spreads(kept, numbered, batch) for kept, numbered in _vector_scans(chunks, asked, batch)]
    )
    left = materialize(asked.join(measured, "request_id"))
    parts, top, told = [], FIRST_TOP, ("total", "low", "high")
    while True:
        tried = left.withColumn("top", F.lit(top))
        its = profile(tried)
        if its.count == 0:
            break
        scans = [] if its.is_shared else _vector_scans(chunks, tried, its, told)
        if len(scans) == 1 and top <= LONGEST_CUT:
            # the hits of a request come up in one task, and only those before its cut leave it
            seen = materialize(scan_cut(*scans[0], its))
            before = seen.where("settled").drop("settled")
        elif top <= WINDOW_TOP:
            best = top_k(nearest(chunks, tried, its), top, from_all_tasks=its.is_shared)
            seen = materialize(auto_cut_first(beside_requests(best, left.select("request_id", *told).distinct(), its)))
            before = seen.where(F.col("settled") & (F.col("cut_group") < F.col("auto_limit")))
            before = before.withColumn("top", F.lit(None).cast("int")).drop(*told, "cut_group", "settled")
        else:
            break
        parts.append(before)
        left = materialize(left.join(seen.where("NOT settled").select("request_id").distinct(), "request_id", "left_semi"))
        top *= TOP_STEP
    return parts, left.drop(*told)


def _narrow(chunks: DataFrame, batch: BatchProfile, fields: tuple[str, ...]) -> DataFrame:
    """Ids and ``fields`` of chunks. Beside unbounded hits only those with a searched vector, unless parents join these."""
    ids = ["tenant", "chunk_id"]
    narrow = chunks.select(*ids, *[f for f in fields if f not in ids])
    if batch.with_parents or batch.max_hits is not None or batch.count == 0:
        return narrow
    searched = reduce(Column.__or__, [column.isNotNull() for column in _vector_columns(batch)])
    return narrow.join(chunks.where(searched).select(*ids).distinct(), ids, "left_semi")


def _rows(
    hits: DataFrame,
    chunks: DataFrame,
    requests: DataFrame,
    batch: BatchProfile,
    fetch: Fetch | None,
    by_file: bool,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Full chunk rows of the hits and parents, or their ids and ``fields``, with the vector of requests that want it.

    ``fetch`` gives the chunks of ids from where they are stored; without it they are joined, and where they
    are grouped ``by_file`` next, in the partitions of their files.
    """
    if fields is not None and not batch.with_vectors and fetch is None:
        return fetch_chunks(
            apply_parent_strategy(hits, requests, batch), _narrow(chunks, batch, fields), batch, narrow=True
        )
    keys = apply_parent_strategy(hits, requests, batch)
    if batch.with_vectors:  # told to ids, so that contents need not move to the requests
        keys = beside_requests(keys, requests.select("request_id", "vector_name", "include_vector"), batch)
    else:
        chunks = chunks.drop("embeddings")
    joined = fetch_by_file if by_file else fetch_chunks
    rows = fetch(keys, batch) if fetch else joined(keys, chunks, batch)
    if not batch.with_vectors:
        return rows.drop("embeddings")
    picked = pick_vector(F.col("embeddings"), F.col("vector_name"))
    return rows.withColumn("embedding", F.when(F.col("include_vector"), picked)).drop(
        "embeddings", "vector_name", "include_vector"
    )


def vector_search(
    chunks: DataFrame,
    requests: DataFrame,
    defaults: dict[str, Any] | None = None,
    by_file: bool = True,
    in_tiles: bool = False,
    part_chunks: int | None = None,
    fetch: Fetch | None = None,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Nearest chunks of each request, as documents per file or, with ``by_file`` off, as rows.

    Order of work: property, level and tenant filters, distance, ``horizon``, ``top``,
    ``auto_limit``, then the parent strategy and the regrouping per file. Rows have all columns of their
    chunks, or with ``fields`` only the ids and those, so that long lists need not move to contents.
    """
    asked = with_defaults(requests, defaults)
    batch = profile(asked)
    asked = settle(asked, batch)
    hits = nearest_ranked(chunks, asked, batch, in_tiles)
    if by_file:
        return group_by_file(_rows(hits, chunks, asked, batch, fetch, by_file), part_chunks)
    return _rows(hits, chunks, asked, batch, fetch, by_file, fields)


def text_search(
    chunks: DataFrame,
    requests: DataFrame,
    defaults: dict[str, Any] | None = None,
    by_file: bool = True,
    embed: Embedder = hashed_term_vector,
    fetch: Fetch | None = None,
) -> DataFrame:
    """Vector search with the embedded ``query_text``; ``embed`` is the chunks' own embedder."""
    embedded = requests.withColumn("query_embedding", embed(F.col("query_text")))
    return vector_search(chunks, embedded, defaults, by_file, fetch=fetch)


def _with_terms(
    chunks: DataFrame, requests: DataFrame, batch: BatchProfile, counts: DataFrame | None = None
) -> DataFrame:
    terms = hybrid.query_terms(chunks, requests, batch, counts)
    complete = requests.join(terms, "request_id", "left").withColumns(
        {
            "terms": F.coalesce("terms", F.array().cast("array<string>")),
            "idf": F.coalesce("idf", F.array().cast("array<double>")),
            "avg_length": F.coalesce("avg_length", F.lit(1.0)),
        }
    )
    return settle(complete, batch)


def _as_scores(rows: DataFrame) -> DataFrame:
    return rows.withColumn("score", -F.col("distance")).drop("distance")


def keyword_search(
    chunks: DataFrame, requests: DataFrame, defaults: dict[str, Any] | None = None
) -> DataFrame:
    """``request_id, tenant, chunk_id, score, rank``: chunks by BM25 score of ``query_text``."""
    asked = with_defaults(requests, defaults)
    batch = profile(asked)
    asked = settle(asked, batch)
    if batch.count == 0:
        hits = ranked(nearest(chunks, asked, batch), batch)
        return _as_scores(hits.select("request_id", "tenant", "chunk_id", "distance", "rank"))
    columns = [*[F.col(c) for c in _IDS], tokens(F.col("content")).alias("tokens")]
    prepared = _with_terms(chunks, asked.withColumn("slot", F.lit(0)), batch)
    parts = [
        hybrid.text_search_scan(kept, numbered.select(*_ASKED, "terms", "idf", "avg_length"), batch)
        for kept, numbered in by_filters(chunks, prepared, columns)
    ]
    hits = ranked(reduce(DataFrame.unionByName, parts), batch)
    return _as_scores(hits.select("request_id", "tenant", "chunk_id", "distance", "rank"))


def stored_keyword_search(
    spark: SparkSession, name: str, requests: DataFrame, defaults: dict[str, Any] | None = None
) -> DataFrame:
    """Like ``keyword_search`` over a collection with a text index, whose contents are not read.

    Terms meet stored postings in an equi-join. Chunks are only looked at, without their contents, where
    requests have property or level filters.
    """
    asked = with_defaults(requests, defaults)
    batch = profile(asked)
    asked = settle(asked, batch)
    scoped = hybrid.asked_terms(asked)
    postings, counts = stored_postings(spark, name), stored_counts(spark, name)
    terms = scoped.select("term").distinct()
    if batch.is_small:
        listed = [r["term"] for r in terms.limit(LISTED_TERMS + 1).collect()]
        if len(listed) <= LISTED_TERMS:  # literals that Parquet checks against its statistics
            postings = postings.where(F.col("term").isin(listed))
            counts = counts.where(F.col("term").isin([*listed, ""]))
    weighted = settle_costly(hybrid.weighted_terms(scoped, counts, batch))
    scores = hybrid.posting_scores(postings, weighted, batch)
    if asked.where("operation_level IS NOT NULL OR having_all IS NOT NULL OR having_any IS NOT NULL").isEmpty():
        scores = beside_requests(scores, asked.select("request_id", "top", "auto_limit"), batch)
    else:
        chunks = scan_collection(spark, name)
        parts = []
        for kept, numbered in by_filters(chunks, asked, [F.col("tenant"), F.col("chunk_id")]):
            mine = beside_requests(scores, numbered.select("request_id", "top", "auto_limit", "spec"), batch)
            fit = mine.join(kept, ["tenant", "chunk_id"])
            if "specs" in fit.columns:
                fit = fit.where(F.array_contains("specs", F.col("spec")))
            parts.append(fit.select(*scores.columns, "top", "auto_limit"))
        scores = reduce(DataFrame.unionByName, parts)
    hits = scores.select(
        "request_id", "tenant", "chunk_id", F.lit(None).cast("string").alias("parent_id"),
        "top", "auto_limit", (-F.col("score")).alias("distance"),
    )
    hits = ranked(hits, batch)
    return _as_scores(hits.select("request_id", "tenant", "chunk_id", "distance", "rank"))


def hybrid_search(
    chunks: DataFrame,
    requests: DataFrame,
    defaults: dict[str, Any] | None = None,
    by_file: bool = True,
    embed: Embedder = hashed_term_vector,
    fetch: Fetch | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Keyword and vector relevance blended by ``alpha``; higher ``score`` first.

    In documents per file the ``distance`` of a chunk is its negative score.
    A request without ``query_embedding`` is embedded from its text. The chunks are read three times:
    for the statistics of terms (unless stored ``counts`` are given), for the range of both scores per
    request, and for the blended scores.
    """
    asked = with_defaults(requests, {"alpha": hybrid.ALPHA, **(defaults or {})})
    asked = asked.withColumn(
        "query_embedding", F.coalesce("query_embedding", embed(F.col("query_text")))
    )
    batch = profile(asked)
    asked = settle(asked, batch)
    if batch.count == 0:
        rows = _rows(ranked(nearest(chunks, asked, batch), batch), chunks, asked, batch, fetch, by_file)
        return group_by_file(rows) if by_file else _as_scores(rows)
    columns = [
        *[F.col(c) for c in _IDS],
        *_vector_columns(batch),
        tokens(F.col("content")).alias("tokens"),
    ]
    prepared = _with_terms(chunks, _slots(asked, batch), batch, counts)
    parts = []
    for kept, numbered in by_filters(chunks, prepared, columns):
        numbered = numbered.select(*_ASKED, "alpha", "terms", "idf", "avg_length")
        ranges = hybrid.score_ranges(kept, numbered, batch)
        parts.append(hybrid.hybrid_scan(kept, numbered.join(ranges, "request_id"), batch))
    hits = ranked(reduce(DataFrame.unionByName, parts), batch)
    rows = _rows(hits, chunks, asked, batch, fetch, by_file)
    if not by_file:
        return _as_scores(rows)
    return group_by_file(rows)


def search_one(
    chunks: DataFrame,
    query_embedding: list[float],
    method: str = "cosine",
    vector_name: str | None = None,
    top: int | None = None,
    horizon: float | None = None,
    operation_level: int | None = None,
    having_all: dict | None = None,
    having_any: dict | None = None,
    tenant_name: str | None = None,
) -> DataFrame:
    """One request as a plan of built-in expressions: filter, distance, sort, limit."""
    spec = {
        "tenant_name": tenant_name,
        "operation_level": operation_level,
        "having_all": having_all,
        "having_any": having_any,
    }
    keep = predicate(chunks, spec)
    query = F.array(*[F.lit(float(x)) for x in query_embedding]).cast("array<float>")
    vector = pick_vector(F.col("embeddings"), F.lit(vector_name).cast("string"))
    found = (chunks if keep is None else chunks.where(keep)).where(vector.isNotNull())
    found = found.withColumn("distance", distance(vector, query, method))
    found = found.where(F.col("distance").isNotNull())
    if horizon is not None:
        found = found.where(F.col("distance") <= horizon)
    found = found.orderBy("distance", "chunk_id", "tenant")
    return found if top is None else found.limit(top)
