"""Chunk identifiers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX32 = "^[0-9a-f]{32}$"


def uuid_column(value: Column) -> Column:
    """Lower-case canonical UUID; braces, ``urn:uuid:`` and missing dashes are accepted.

    A value that is no UUID raises when the row is read.
    """
    bare = F.regexp_replace(F.lower(value), r"urn:|uuid:|[{}\-]", "")
    dashed = F.regexp_replace(
        bare, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )
    failure = F.raise_error(F.concat(F.lit("not a UUID: "), value)).cast("string")
    return F.when(value.isNull(), F.lit(None)).when(bare.rlike(_HEX32), dashed).otherwise(failure)


def uuid_list(ids: object) -> list[str]:
    """One id or a list of ids (text or UUID) as canonical text; ``ValueError`` otherwise."""
    many = ids if isinstance(ids, (list, tuple, set)) else [ids]
    return [str(i if isinstance(i, uuid.UUID) else uuid.UUID(str(i))) for i in many]


def id_list(ids: object) -> list[str]:
    """As ``uuid_list`` without the UUID check."""
    many = ids if isinstance(ids, (list, tuple, set)) else [ids]
    return [str(i) for i in many]
