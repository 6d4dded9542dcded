"""Search requests: one row each, completed from configured defaults and profiled as a batch."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.operators.storage import materialize, remove, staged
from chunkloom.schema import DEFAULT_VECTOR, METHODS, REQUEST_SCHEMA

_BUILT_IN = {"method": "cosine", "vector_name": DEFAULT_VECTOR, "include_vector": False}
_TEXTS = ("collection_name", "tenant_name", "vector_name", "method", "parent_strategy")


def with_defaults(requests: DataFrame, defaults: dict[str, Any] | None = None) -> DataFrame:
    """Requests with every known parameter present: request value, else default, else built-in.

    Blank text counts as unset. Unknown keys of ``defaults`` are ignored and a default that does
    not fit its type is unset. Columns that are no parameter are kept.
    """
    known = {f.name: f.dataType for f in REQUEST_SCHEMA.fields}
    configured = {
        k: json.dumps(v) if isinstance(v, dict) else v
        for k, v in (defaults or {}).items()
        if k in known and not isinstance(v, (list, tuple))
    }
    columns = []
    for name, data_type in known.items():
        given = F.col(name).cast(data_type) if name in requests.columns else F.lit(None).cast(data_type)
        if name in _TEXTS:
            given = F.nullif(given, F.lit(""))
        choices = [given]
        for source in (configured, _BUILT_IN):
            if source.get(name) is not None:
                value = F.lit(source[name])
                if name in _TEXTS:
                    value = F.nullif(value.cast("string"), F.lit(""))
                fits = isinstance(source[name], (int, float, bool)) or name in _TEXTS
                choices.append(value.cast(data_type) if fits else value.try_cast(data_type))
        columns.append(F.coalesce(*choices).alias(name))
    extra = [c for c in requests.columns if c not in known]
    return requests.select(*columns, *extra)


SMALL_REQUESTS = 32 << 20
# Every task that meets a batch whole holds its hits and sends the nearest of each request, so beyond this
# its parts are dealt to tasks.
SHARED_REQUESTS = 2 << 20
SHARED_HITS = 1 << 18


@dataclass(frozen=True)
class BatchProfile:
    """What the plan must know about a batch of requests, from one pass over the requests."""

    count: int
    bytes: int
    top: int | None  # largest top, or None when a request has no top
    limited_hits: int  # bound on the hits of the requests that have a top
    auto_limit: int | None
    methods: tuple[str, ...]
    vector_names: tuple[str, ...]
    with_parents: bool
    with_vectors: bool
    with_tenants: bool

    @property
    def is_small(self) -> bool:
        """Whether the requests may be sent to every task."""
        return self.bytes <= SMALL_REQUESTS

    @property
    def is_shared(self) -> bool:
        """Whether every task that scores chunks meets the whole batch."""
        return self.is_small and self.bytes <= SHARED_REQUESTS and self.limited_hits <= SHARED_HITS

    @property
    def max_hits(self) -> int | None:
        """Bound on the hits of the whole batch, if there is one."""
        return None if self.top is None else self.limited_hits


def row_bytes(rows: DataFrame) -> Column:
    """Size of a row with all its columns: texts by their bytes, lists by their elements."""
    sizes = [F.lit(64).cast("bigint")]
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(column)
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
            size = 8 * F.size(column)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            size = F.octet_length(F.to_json(F.struct(column)))
        else:
            size = F.lit(8)
        sizes.append(F.coalesce(size, F.lit(0)).cast("bigint"))
    return reduce(add, sizes)


def profile(requests: DataFrame) -> BatchProfile:
    """One aggregate over completed requests; also checks the methods."""
    row = requests.agg(
        F.count("*").alias("n"),
        F.sum(row_bytes(requests)).alias("bytes"),
        F.max("top").alias("top"),
        F.bool_or(F.col("top").isNull()).alias("no_top"),
        F.sum(F.greatest("top", F.lit(0)).cast("bigint")).alias("limited_hits"),
        F.max("auto_limit").alias("auto_limit"),
        F.collect_set("method").alias("methods"),
        F.collect_set("vector_name").alias("names"),
        F.bool_or(F.col("parent_strategy").isNotNull()).alias("parents"),
        F.bool_or("include_vector").alias("vectors"),
        F.bool_or(F.col("tenant_name").isNotNull()).alias("tenants"),
    ).first()
    unknown = sorted(set(row["methods"]) - set(METHODS))
    if unknown:
        raise ValueError(f"unknown distance methods {unknown}, expected {METHODS}")
    return BatchProfile(
        count=row["n"],
        bytes=row["bytes"] or 0,
        top=None if row["no_top"] else row["top"],
        limited_hits=row["limited_hits"] or 0,
        auto_limit=row["auto_limit"],
        methods=tuple(sorted(row["methods"])),
        vector_names=tuple(sorted(row["names"])),
        with_parents=bool(row["parents"]),
        with_vectors=bool(row["vectors"]),
        with_tenants=bool(row["tenants"]),
    )


def settle(requests: DataFrame, batch: BatchProfile) -> DataFrame:
    """Requests computed once, since a search reads them several times.

    A batch within the broadcast bound becomes a local table, a larger one is written out. Columns
    added since the batch was profiled count too.
    """
    size = requests.agg(F.sum(row_bytes(requests))).first()[0] or 0
    if not batch.is_small or size > SMALL_REQUESTS:
        return materialize(requests)
    return requests.sparkSession.createDataFrame(requests.toArrow(), requests.schema)


def settle_costly(rows: DataFrame) -> DataFrame:
    """Like ``settle`` for rows that are dear to compute: their size is read from a written copy."""
    copy, path = staged(rows)
    if (copy.agg(F.sum(row_bytes(copy))).first()[0] or 0) > SMALL_REQUESTS:
        return copy
    local = rows.sparkSession.createDataFrame(copy.toArrow(), rows.schema)
    remove(rows.sparkSession, path)
    return local
