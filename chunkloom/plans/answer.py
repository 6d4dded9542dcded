"""Requests that name their collection, answered as JSON documents."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.errors import NoCollectionProvided
from chunkloom.operators.regroup import documents_json
from chunkloom.operators.requests import profile, settle, with_defaults
from chunkloom.plans.search import vector_search
from chunkloom.sources.catalog import has_buckets, scan_collection, tenants
from chunkloom.sources.fetch import fetch_stored


def answer(
    spark: SparkSession,
    requests: DataFrame,
    defaults: dict[str, Any] | None = None,
    search: Callable[..., DataFrame] = vector_search,
) -> DataFrame:
    """``request_id, first_place, part, parts, document``: each request on its own collection.

    A collection or tenant that does not exist is a ``KeyError``. There is one scan per named
    collection, of which there are as many as tables at most.
    """
    asked = with_defaults(requests, defaults)
    asked = settle(asked, profile(asked))
    names = [r["collection_name"] for r in asked.select("collection_name").distinct().collect()]
    if None in names:
        raise NoCollectionProvided("a request names no collection and there is no default")
    parts = []
    for name in sorted(names):
        chunks = scan_collection(spark, name)
        mine = asked.where(F.col("collection_name") == name)
        wanted = mine.where(F.col("tenant_name").isNotNull()).select(F.col("tenant_name").alias("tenant"))
        missing = wanted.join(tenants(spark, name), "tenant", "left_anti").first()
        if missing is not None:
            raise KeyError(f"tenant {missing['tenant']} does not exist in collection {name}")
        fetch = fetch_stored(spark, name) if has_buckets(spark, name) else None
        parts.append(documents_json(search(chunks, mine, defaults, fetch=fetch)))
    if not parts:
        return spark.createDataFrame(
            [], "request_id string, first_place bigint, part bigint, parts bigint, document string"
        )
    return reduce(DataFrame.unionByName, parts)
