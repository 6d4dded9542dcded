"""Vector distances as Column expressions; smaller always means nearer, arithmetic is DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom.schema import METHODS


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(inner_product(a, a))


def distance(a: Column, b: Column, method: str = "cosine") -> Column:
    """Distance between two ``array<float>`` columns.

    Null when either vector is null and, for cosine, when either has length zero; vectors of
    different size raise.
    """
    if method == "cosine":
        scale = F.nullif(norm(a) * norm(b), F.lit(0.0))
        value = F.least(F.greatest(1 - inner_product(a, b) / scale, F.lit(0.0)), F.lit(2.0))
        value = F.when(scale.isNotNull(), value)
    elif method == "dot":
        value = -inner_product(a, b)
    elif method in ("l2-squared", "manhattan", "hamming"):

        def term(x: Column, y: Column) -> Column:
            gap = x.cast("double") - y.cast("double")
            if method == "l2-squared":
                return gap * gap
            if method == "manhattan":
                return F.abs(gap)
            return F.when(gap != 0, 1.0).otherwise(0.0)

        value = _sum(F.zip_with(a, b, term))
    else:
        raise ValueError(f"unknown distance method '{method}', expected one of {METHODS}")
    mismatch = F.raise_error(
        F.format_string("vectors of different size: %d and %d", F.size(a), F.size(b))
    ).cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(F.size(a) != F.size(b), mismatch)
        .otherwise(value)
    )


def pick_vector(embeddings: Column, name: Column) -> Column:
    """The named vector of a row, ``default`` when the name is null or empty, null if absent."""
    key = F.coalesce(F.nullif(name, F.lit("")), F.lit("default"))
    return F.try_element_at(embeddings, key)
