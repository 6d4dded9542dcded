"""Requests with different filters in one scan of the chunks.

The distinct filters of a batch become numbered Column predicates. With one filter it is simply
the scan's WHERE; with several, the WHERE is their disjunction and each chunk carries the numbers
of the filters it passes. More than ``MAX_SPECS`` filters are worked off in further scans.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from chunkloom.operators.levels import at_level
from chunkloom.operators.predicates import compile_filter

MAX_SPECS = 128
SPEC_COLUMNS = ("tenant_name", "operation_level", "having_all", "having_any")
_SPEC_DDL = "tenant_name string, operation_level int, having_all string, having_any string, spec int"


def predicate(chunks: DataFrame, spec: Row | dict) -> Column | None:
    """Predicate of one filter: tenant, level and properties."""
    tenant = spec["tenant_name"]
    scope = chunks if tenant is None else chunks.where(F.col("tenant") == tenant)
    parts = [
        None if tenant is None else F.col("tenant") == tenant,
        at_level(scope, spec["operation_level"]),
        compile_filter(chunks.schema, spec["having_all"], spec["having_any"]),
    ]
    parts = [p for p in parts if p is not None]
    return reduce(and_, parts) if parts else None


def by_filters(
    chunks: DataFrame, requests: DataFrame, columns: list[Column]
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Pairs of (filtered chunks with ``columns``, requests with their ``spec``), one per scan."""
    specs = requests.select(*SPEC_COLUMNS).distinct().collect()
    specs = sorted(specs, key=lambda s: tuple((v is not None, v) for v in s))
    for start in range(0, len(specs), MAX_SPECS):
        chosen = specs[start : start + MAX_SPECS]
        predicates = [predicate(chunks, s) for s in chosen]
        if len(specs) == 1:
            kept = chunks if predicates[0] is None else chunks.where(predicates[0])
            yield kept.select(*columns), requests.withColumn("spec", F.lit(0))
            continue
        numbers = [F.lit(i) if p is None else F.when(p, i) for i, p in enumerate(predicates)]
        kept = chunks
        if all(p is not None for p in predicates):
            kept = chunks.where(reduce(or_, predicates))
        tenants = {s["tenant_name"] for s in chosen}
        if None not in tenants:
            kept = kept.where(F.col("tenant").isin(sorted(tenants)))
        kept = kept.select(*columns, F.array_compact(F.array(*numbers)).alias("specs"))
        table = chunks.sparkSession.createDataFrame(
            [(*s, i) for i, s in enumerate(chosen)], _SPEC_DDL
        )
        same = [requests[c].eqNullSafe(table[c]) for c in SPEC_COLUMNS]
        numbered = requests.join(F.broadcast(table), reduce(and_, same)).select(
            requests["*"], table["spec"]
        )
        yield kept, numbered
