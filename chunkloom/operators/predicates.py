"""Property filters: a dictionary of conditions compiled to one Column predicate.

A key is ``path [indicator]``, split at its last space; without a space the indicator is ``==``.
A path resolves to a fixed column, a STRUCT field (so that pruning and Parquet pushdown apply), a
map key or a path inside a VARIANT. A missing property never matches, whatever the indicator, and
a value of another type class than the literal never matches either.
"""

from __future__ import annotations

import datetime
import decimal
import json
from collections.abc import Callable
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.errors import InvalidFilter

# The comparison indicators of the filter grammar.
COMPARISONS = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}
INDICATORS = (*COMPARISONS, "contains", "in", "not-in", "~")

_VARIANT_CLASSES = {
    "text": ("STRING",),
    "boolean": ("BOOLEAN",),
    "number": ("BIGINT", "INT", "DOUBLE", "FLOAT", "DECIMAL", "SMALLINT", "TINYINT"),
    "time": ("STRING", "TIMESTAMP", "DATE"),
}
_VARIANT_TYPES = {"text": "string", "boolean": "boolean", "number": "double", "time": "timestamp"}


def split_key(key: str) -> tuple[str, str]:
    """Path and indicator of a filter key."""
    path, _, indicator = key.rpartition(" ") if " " in key else (key, "", "==")
    if indicator not in INDICATORS:
        raise ValueError(f"unknown filter indicator '{indicator}' in '{key}'")
    return path.strip(), indicator


def _value_class(value: Any) -> str | None:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    if isinstance(value, str):
        return "text"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return "time"
    return None


def _type_classes(data_type: T.DataType) -> tuple[str, ...]:
    if isinstance(data_type, T.BooleanType):
        return ("boolean",)
    if isinstance(data_type, T.NumericType):
        return ("number",)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return ("time", "text")  # JSON filters spell dates as text
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return ("text",)
    return ()


def like_pattern(value: str) -> str:
    """SQL LIKE pattern in which only ``*`` is a wild card."""
    for special in ("\\", "%", "_"):
        value = value.replace(special, "\\" + special)
    return value.replace("*", "%")


def _never() -> Column:
    return F.lit(False)


class _Property:
    """A resolved path: a Column with its type, or a path below a VARIANT column."""

    def __init__(self, column: Column, data_type: T.DataType, below: list[str]):
        self.column = column
        self.data_type = data_type
        self.below = below

    @classmethod
    def resolve(cls, schema: T.StructType, path: str) -> _Property | None:
        parts = path.split(".")
        if parts[0] == "custom_property":
            parts[0] = "custom_properties"
        if parts[0] not in schema.names:
            return None
        column, data_type = F.col(f"`{parts[0]}`"), schema[parts[0]].dataType
        rest = parts[1:]
        while rest and not isinstance(data_type, T.VariantType):
            if isinstance(data_type, T.StructType) and rest[0] in data_type.names:
                column, data_type = column.getField(rest[0]), data_type[rest[0]].dataType
            elif isinstance(data_type, T.MapType):
                column = F.try_element_at(column, F.lit(rest[0]))
                data_type = data_type.valueType
            else:
                return None
            rest = rest[1:]
        return cls(column, data_type, rest)

    def _variant(self) -> Column:
        if any('"' in part for part in self.below):
            raise ValueError("a property name may not hold a double quote")
        path = "$" + "".join(f'["{part}"]' for part in self.below)
        return F.try_variant_get(self.column, path, "variant") if self.below else self.column

    def scalar(self, value: Any) -> Column | None:
        """The property as a Column comparable with ``value``; null where the class differs."""
        wanted = _value_class(value)
        if wanted is None:
            return None
        if isinstance(self.data_type, T.VariantType):
            return _variant_scalar(self._variant(), wanted)
        return self.column if wanted in _type_classes(self.data_type) else None

    def holds_any(self, values: list[Any]) -> Column:
        """True when the list property, or the plain property, equals one of the values."""
        if isinstance(self.data_type, T.VariantType):
            stored = self._variant()
            is_list = F.schema_of_variant(stored).startswith("ARRAY")
            items = F.when(is_list, stored).cast("array<variant>")
            items = F.coalesce(items, F.when(stored.isNotNull(), F.array(stored)))
            return F.exists(items, lambda item: _any(_variant_equals(item, v) for v in values))
        if isinstance(self.data_type, T.ArrayType):
            classes = _type_classes(self.data_type.elementType)
            usable = [F.lit(v) for v in values if _value_class(v) in classes]
            return F.arrays_overlap(self.column, F.array(*usable)) if usable else _never()
        return self.equals_any(values)

    def equals_any(self, values: list[Any]) -> Column:
        if isinstance(self.data_type, T.VariantType):
            return _any(_variant_equals(self._variant(), v) for v in values)
        usable = [v for v in values if self.scalar(v) is not None]
        return self.column.isin(usable) if usable else _never()

    def present(self) -> Column:
        if isinstance(self.data_type, T.VariantType):
            stored = self._variant()
            return stored.isNotNull() & ~F.coalesce(F.is_variant_null(stored), F.lit(False))
        return self.column.isNotNull()


def _any(conditions) -> Column:
    return reduce(or_, conditions, _never())


def _variant_scalar(stored: Column, wanted: str) -> Column:
    kind = F.schema_of_variant(stored)
    matches = reduce(or_, [kind.startswith(name) for name in _VARIANT_CLASSES[wanted]])
    return F.when(matches, F.try_variant_get(stored, "$", _VARIANT_TYPES[wanted]))


_EXACT = "decimal(38,18)"  # holds every 64-bit integer and 18 digits behind the point


def _variant_compare(stored: Column, value: Any, compare: Callable[[Column, Column], Column]) -> Column:
    """A comparison with a VARIANT value; integers are compared as such, not as doubles."""
    wanted = _value_class(value)
    if wanted is None:
        return _never()
    whole = isinstance(value, int) and not isinstance(value, bool)
    if not whole or abs(value) >= 10**20:
        return compare(_variant_scalar(stored, wanted), F.lit(float(value) if whole else value))
    kind = F.schema_of_variant(stored)
    floating = kind.startswith("DOUBLE") | kind.startswith("FLOAT")
    exact = F.when(_is_number(kind) & ~floating, F.try_variant_get(stored, "$", _EXACT))
    rounded = F.when(floating, F.try_variant_get(stored, "$", "double"))
    return F.coalesce(
        compare(exact, F.lit(decimal.Decimal(value)).cast(_EXACT)), compare(rounded, F.lit(float(value)))
    )


def _is_number(kind: Column) -> Column:
    return reduce(or_, [kind.startswith(name) for name in _VARIANT_CLASSES["number"]])


def _variant_equals(stored: Column, value: Any) -> Column:
    return _variant_compare(stored, value, COMPARISONS["=="])


def condition(schema: T.StructType, key: str, value: Any) -> Column:
    """One entry of a filter as a predicate that is never null-sensitive to missing properties."""
    path, indicator = split_key(key)
    prop = _Property.resolve(schema, path)
    if indicator in ("in", "not-in") and not isinstance(value, (list, tuple, set)):
        raise ValueError(f"'{key}' expects a list")
    if prop is None:
        return _never()
    if indicator == "contains":
        return prop.holds_any(list(value) if isinstance(value, (list, tuple, set)) else [value])
    if indicator == "in":
        return prop.equals_any(list(value))
    if indicator == "not-in":
        return prop.present() & ~F.coalesce(prop.equals_any(list(value)), _never())
    if isinstance(prop.data_type, T.VariantType) and indicator in COMPARISONS:
        return _variant_compare(prop._variant(), value, COMPARISONS[indicator])
    stored = prop.scalar(value)
    if stored is None:
        return _never()
    if indicator == "~":
        return stored.like(like_pattern(value)) if isinstance(value, str) else _never()
    return COMPARISONS[indicator](stored, F.lit(value))


def _entries(conditions: Any) -> dict[str, Any] | None:
    """A filter given as a dictionary or as JSON text; null, blank and JSON null mean none."""
    if isinstance(conditions, str):
        conditions = json.loads(conditions) if conditions.strip() else None
    if conditions is None:
        return None
    if not isinstance(conditions, dict) or not conditions:
        raise InvalidFilter("a filter must be a dictionary with at least one condition")
    return conditions


def compile_filter(
    schema: T.StructType, having_all: Any = None, having_any: Any = None
) -> Column | None:
    """Predicate of both dictionaries (ANDed), or None when neither is given."""
    parts = []
    every, some = _entries(having_all), _entries(having_any)
    if every is not None:
        parts.append(reduce(and_, [condition(schema, k, v) for k, v in every.items()]))
    if some is not None:
        parts.append(reduce(or_, [condition(schema, k, v) for k, v in some.items()]))
    return reduce(and_, parts) if parts else None
