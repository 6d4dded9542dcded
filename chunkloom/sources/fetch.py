"""Chunks of a stored collection by id, without reading or moving those of other ids.

Hits of a search are few and their contents are long, so a fetch first finds out where the hits lie:

* the ids alone tell the partitions (tenant, and a hash of the id), which become literal partition
  filters, so that a hit in one tenant does not touch another;
* ids become equalities or ranges that Parquet checks against the statistics of row groups and pages,
  in files that are sorted by id;
* with these, one look at the id column names the files that really hold a hit, and only those files
  are opened for contents.

Hits are sent to the files, not contents to the hits: in groups of partitions with up to
``BROADCAST_HITS`` hits each. Only a partition with more hits than that is joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.operators.parents import BROADCAST_HITS
from chunkloom.operators.requests import BatchProfile
from chunkloom.operators.storage import staged
from chunkloom.schema import BUCKET
from chunkloom.sources.catalog import inside, open_table, per_partition, with_bucket

_KEYS = ["tenant", BUCKET, "chunk_id"]
LISTED_IDS = 200_000
RANGES = 64
LISTED_FILES = 5_000
Part = tuple[str, int]


def id_ranges(ids: list[str], ranges: int = RANGES) -> Column:
    """A predicate on ``chunk_id`` that holds for all ``ids`` and that Parquet can check by statistics."""
    ids = sorted(set(ids))
    size = max(1, -(-len(ids) // ranges))
    parts = []
    for i in range(0, len(ids), size):
        first, last = ids[i], ids[min(i + size, len(ids)) - 1]
        chunk_id = F.col("chunk_id")
        parts.append(chunk_id == first if first == last else chunk_id.between(first, last))
    return reduce(or_, parts, F.lit(False))


def grouped(per_part: dict[Part, int], bound: int) -> list[list[Part]]:
    """Partitions in groups of up to ``bound`` hits; one with more is a group of its own."""
    groups: list[list[Part]] = []
    held = bound
    for part in sorted(per_part):
        if held + per_part[part] > bound:
            groups.append([])
            held = 0
        groups[-1].append(part)
        held += per_part[part]
    return groups


def _one_group(stored: DataFrame, keys: DataFrame, parts: list[Part], hits: int, bound: int) -> DataFrame:
    """The stored rows of ``keys``, all of which lie in ``parts``."""
    keys = keys.where(inside(parts))
    where = stored.where(inside(parts))
    small = hits <= bound
    if hits <= LISTED_IDS:
        ids = [r[0] for r in keys.select("chunk_id").distinct().collect()]
        where = where.where(id_ranges(ids))
        there = where.select(*_KEYS, F.col("_metadata.file_path").alias("file"))
        wanted = keys.select(*_KEYS).distinct()
        there = there.join(F.broadcast(wanted) if small else wanted, _KEYS, "left_semi")
        files = [r[0] for r in there.select("file").distinct().limit(LISTED_FILES + 1).collect()]
        if len(files) <= LISTED_FILES:
            where = where.where(F.col("_metadata.file_path").isin(files))
    return where.join(F.broadcast(keys) if small else keys, _KEYS)


def fetch_stored(
    spark: SparkSession, name: str, bound: int = BROADCAST_HITS
) -> Callable[[DataFrame, BatchProfile], DataFrame]:
    """The fetch of a search over the collection ``name``; it runs the search and keeps its hits."""

    def fetch(rows: DataFrame, batch: BatchProfile) -> DataFrame:
        keys, _ = staged(with_bucket(spark, name, rows), "hits")
        per_part = per_partition(keys)
        stored = open_table(spark, name)
        found = [
            _one_group(stored, keys, parts, sum(per_part[p] for p in parts), bound)
            for parts in grouped(per_part, bound)
        ]
        if not found:
            found = [stored.where(F.lit(False)).join(keys, _KEYS)]
        return reduce(DataFrame.unionByName, found).drop(BUCKET)

    return fetch
