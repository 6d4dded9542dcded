"""Nested properties: flatten to dotted paths, hash to flat names, and rebuild."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_DEPTH = 8
_ENTRY = "array<struct<path:string,value:variant>>"


def flat_name(path: Column) -> Column:
    """``property_`` plus the MD5 of the dotted path; an array of parts is joined first."""
    return F.concat(F.lit("property_"), F.md5(path.cast("binary")))


def flat_name_of_parts(parts: Column) -> Column:
    return flat_name(F.array_join(parts, "."))


def _as_map(value: Column) -> Column:
    """The members of a VARIANT object, null for anything else. It looks at one level: the schema of
    a value would walk all that lies below."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def is_object(value: Column) -> Column:
    return _as_map(value).isNotNull()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable, so that a nested expression does not repeat it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _entry(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"))


def _members(value: Column) -> Column:
    """The entries of a VARIANT object, an empty array for anything else."""
    return F.coalesce(F.map_entries(_as_map(value)), F.array().cast("array<struct<key:string,value:variant>>"))


def _top_members(value: Column, prefix: str) -> Column:
    first = F.lit(prefix + "." if prefix else "")
    return F.transform(_members(value), lambda m: _entry(F.concat(first, m["key"]), m["value"]))


def _opened(entries: Column) -> Column:
    """Entries with every object replaced by its members, in its place."""

    def members(e: Column) -> Column:
        below = lambda m: _entry(F.concat(e["path"], F.lit("."), m["key"]), m["value"])
        return F.coalesce(F.transform(F.map_entries(_as_map(e["value"])), below), F.array(e))

    return F.flatten(F.transform(entries, members))


def flatten_variant(value: Column, prefix: str = "", max_depth: int = MAX_DEPTH) -> Column:
    """All leaves of a VARIANT object as ``array<struct<path, value>>``.

    Objects are walked, every other value (lists and JSON nulls too) is a leaf and empty objects
    vanish. It is one row-local expression with no generator and no shuffle, unrolled to
    ``max_depth``, for which ``variant_depth`` measures a column; an object below that depth raises
    instead of being lost.
    """
    entries = _top_members(value, prefix)
    for _ in range(max_depth - 1):
        entries = _opened(entries)
    failure = F.raise_error(F.lit(f"properties nested deeper than {max_depth} levels"))

    def checked(leaves: Column) -> Column:
        too_deep = F.exists(leaves, lambda e: is_object(e["value"]))
        return F.when(too_deep, failure.cast(_ENTRY)).otherwise(leaves)

    return _let(entries, checked)


def variant_depth(frame: DataFrame, *values: Column) -> int:
    """How deep the objects of VARIANT columns go, from one aggregate for every eight levels.

    Lists are leaves, and what lies in them does not count. Rows may be of different kinds.
    """
    rows, depth = frame.select(F.array_compact(F.array(*[_as_map(v) for v in values])).alias("objects")), 1
    while True:
        for level in range(MAX_DEPTH):
            # only objects are looked into further
            within = F.flatten(F.transform("objects", lambda o: F.map_values(o)))
            rows = rows.withColumn("objects", F.array_compact(F.transform(within, _as_map)))
            rows = rows.withColumn(f"open{level}", F.size("objects") > 0)
        found = rows.agg(*[F.bool_or(f"open{level}") for level in range(MAX_DEPTH)]).first()
        below = [*found, False].index(False) if all(f is not None for f in found) else 0
        if below < MAX_DEPTH:
            return depth + below
        rows, depth = rows.select("objects"), depth + MAX_DEPTH


def _struct_leaves(
    column: Column, data_type: T.DataType, path: str, walk: Callable[[Column, str], Column]
) -> list[Column]:
    """``walk`` gives the entries of an object in a VARIANT value."""
    if isinstance(data_type, T.StructType):
        leaves = []
        for field in data_type.fields:
            below = f"{path}.{field.name}" if path else field.name
            leaves += _struct_leaves(column.getField(field.name), field.dataType, below, walk)
        return leaves
    if isinstance(data_type, T.VariantType):
        # a VARIANT field may hold an object or a plain value
        plain = F.array(_entry(F.lit(path), column))
        nested = walk(column, path)
        absent = F.array().cast(_ENTRY)
        return [F.when(is_object(column), nested).when(column.isNotNull(), plain).otherwise(absent)]
    value = column.cast("variant")
    # a null struct field is a missing property, so it gives no entry
    present = F.array(_entry(F.lit(path), value))
    return [F.when(column.isNotNull(), present).otherwise(F.array().cast(_ENTRY))]


def flatten_properties(
    column: Column, data_type: T.DataType, prefix: str = "", max_depth: int = MAX_DEPTH
) -> Column:
    """Leaves of a STRUCT or VARIANT column as ``array<struct<path, value>>``, depth first.

    A STRUCT is walked as deep as its type goes; ``max_depth`` is for objects in VARIANT values.
    """
    leaves = _struct_leaves(column, data_type, prefix, lambda value, path: flatten_variant(value, path, max_depth))
    return F.concat(*leaves) if leaves else F.array().cast(_ENTRY)


def last_of_each_path(entries: Column) -> Column:
    """Entries without those whose path comes again later: of equal paths the last one counts."""

    def unique(items: Column) -> Column:
        paths = F.transform(items, lambda e: e["path"])
        later = lambda e, i: F.array_contains(F.slice(paths, i + 2, F.size(paths)), e["path"])
        return F.filter(items, lambda e, i: ~later(e, i))

    return _let(entries, unique)


def property_map(entries: Column) -> Column:
    """``map<flat name, path>`` of flattened entries."""
    return F.map_from_entries(
        F.transform(last_of_each_path(entries), lambda e: F.struct(flat_name(e["path"]), e["path"]))
    )


def flat_properties(entries: Column) -> Column:
    """``map<flat name, value>`` of flattened entries."""
    return F.map_from_entries(
        F.transform(last_of_each_path(entries), lambda e: F.struct(flat_name(e["path"]), e["value"]))
    )


def _head(path: Column) -> Column:
    return F.substring_index(path, ".", 1)


def _tail(path: Column) -> Column:
    return F.when(
        F.contains(path, F.lit(".")), F.substring(path, F.length(_head(path)) + 2, F.length(path))
    )


def unflatten_properties(entries: Column, max_depth: int = MAX_DEPTH) -> Column:
    """Rebuild a nested VARIANT object from ``array<struct<path, value>>``.

    Paths are split on dots and a later entry wins over an earlier one with the same path. Paths
    of more than ``max_depth`` parts raise.
    """

    def build(items: Column, depth: int) -> Column:
        names = F.array_distinct(F.transform(items, lambda e: _head(e["path"])))

        def value_of(same: Column) -> Column:
            """The value of one name: its last entry, or the object its last entry is part of."""
            last = F.element_at(same, -1)
            if depth == max_depth:
                return last["value"]
            below = F.transform(
                F.filter(same, lambda e: _tail(e["path"]).isNotNull()),
                lambda e: _entry(_tail(e["path"]), e["value"]),
            )
            nested = _let(below, lambda deeper: build(deeper, depth + 1))
            return F.when(_tail(last["path"]).isNotNull(), nested).otherwise(last["value"])

        def member(name: Column) -> Column:
            same = F.filter(items, lambda e: _head(e["path"]) == name)
            return F.struct(name.alias("key"), _let(same, value_of).alias("value"))

        # not by way of JSON text, which has no dates and turns doubles into decimals
        return F.to_variant_object(F.map_from_entries(F.transform(names, member)))

    too_long = F.exists(entries, lambda e: F.size(F.split(e["path"], r"\.")) > max_depth)
    failure = F.raise_error(F.lit(f"property path of more than {max_depth} parts"))
    return F.when(too_long, failure.cast("variant")).otherwise(
        _let(entries, lambda items: build(items, 1))
    )


def unmap_properties(flat: Column, names: Column, max_depth: int = MAX_DEPTH) -> Column:
    """Nested VARIANT from ``map<flat name, value>`` and the ``map<flat name, path>``.

    Flat names that the map does not list are dropped.
    """
    return unflatten_properties(_known_entries(flat, names), max_depth)


def _known_entries(flat: Column, names: Column) -> Column:
    """``array<struct<path, value>>`` of the flat names that the map lists."""
    known = F.map_filter(flat, lambda key, _: F.map_contains_key(names, key))
    return F.transform(
        F.map_entries(known),
        lambda e: _entry(F.try_element_at(names, e["key"]), e["value"].cast("variant")),
    )


def rebuild_struct(values: Column, data_type: T.StructType, prefix: str = "") -> Column:
    """Unflatten for a declared schema: a STRUCT read out of ``map<path, value>`` by path."""
    fields = []
    for field in data_type.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        if isinstance(field.dataType, T.StructType):
            part = rebuild_struct(values, field.dataType, path)
        else:
            part = F.try_element_at(values, F.lit(path)).cast(field.dataType)
        fields.append(part.alias(field.name))
    return F.struct(*fields)


def _variants(column: Column, data_type: T.DataType) -> list[Column]:
    """The VARIANT values that a column is or holds in the fields of a STRUCT."""
    if isinstance(data_type, T.StructType):
        return [v for f in data_type.fields for v in _variants(column.getField(f.name), f.dataType)]
    return [column] if isinstance(data_type, T.VariantType) else []


def flattened(frame: DataFrame, column: str, into: str, prefix: str = "") -> DataFrame:
    """``frame`` with ``into``, all leaves of a STRUCT or VARIANT column as deep as they lie.

    A pass over the column measures how deep its objects go; a STRUCT without VARIANT fields needs
    none. Then every level is one row-local step.
    """
    data_type = frame.schema[column].dataType
    value = F.col(f"`{column}`")
    variants = _variants(value, data_type)
    depth = variant_depth(frame, *variants) if variants else 1
    leaves = _struct_leaves(value, data_type, prefix, _top_members)
    frame = frame.withColumn(into, F.concat(*leaves) if leaves else F.array().cast(_ENTRY))
    for _ in range(depth - 1):
        frame = frame.withColumn(into, _opened(F.col(f"`{into}`")))
    return frame


def _shared_parts(one: Column, other: Column) -> Column:
    """How many parts two paths begin with alike; 0 where there is no other."""
    first_other = F.array_position(F.zip_with(one, other, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    alike = F.when(first_other > 0, first_other - 1).otherwise(F.size(one)).cast("int")
    return F.when(other.isNull(), F.lit(0)).otherwise(alike)


def _joints(entries: Column) -> Column:
    """``array<struct<parts, value, at>>`` of entries, cut where paths of the list part.

    What lies below the first part that no other path shares is an object of one member in each level:
    it is built at once. In sorted order the path that shares most is a neighbour.
    """
    paths = F.array_sort(F.transform(entries, lambda e, i: F.struct(F.split(e["path"], r"\.").alias("parts"), i.alias("at"))))

    def cut(ordered: Column) -> Column:
        def joint(own: Column, i: Column) -> Column:
            parts = own["parts"]
            shared = [_shared_parts(parts, F.get(ordered, i + step)["parts"]) for step in (-1, 1)]
            kept = F.greatest(*shared) + 1
            below = F.reverse(F.slice(parts, kept + 1, F.size(parts)))
            value = F.reduce(
                below, F.get(entries, own["at"])["value"], lambda v, name: F.to_variant_object(F.create_map(name, v))
            )
            return F.struct(F.slice(parts, 1, kept).alias("parts"), value.alias("value"), own["at"].alias("at"))

        return F.transform(ordered, joint)

    return _let(paths, cut)


def unflattened(frame: DataFrame, entries: str, into: str) -> DataFrame:
    """``frame`` with ``into``, the objects rebuilt from ``entries`` of paths of any length.

    Like ``unflatten_properties``, but folded from the deepest level up at which paths of a list part,
    one row-local step per level: what has a path of ``depth`` parts becomes members of the object above
    it. Of one path the entry, or the object with a member, that comes last in the list wins.
    """
    own, place = F.col(f"`{entries}`"), F.col(f"`{into}`")
    part = lambda parts, value, at: F.struct(parts.alias("parts"), value.alias("value"), at.alias("at"))
    frame = frame.withColumn(into, _joints(own))
    depth = frame.agg(F.max(F.array_max(F.transform(place, lambda e: F.size(e["parts"]))))).first()[0] or 1

    def last(items: Column) -> Column:
        """Of a list of entries the one that comes last."""
        return F.reduce(items, F.get(items, F.lit(0)), lambda a, b: F.when(b["at"] > a["at"], b).otherwise(a))

    for level in range(depth, 0, -1):
        deep = F.filter(place, lambda e: F.size(e["parts"]) == level)
        frame = frame.withColumns({f"{into}__deep": deep, into: F.filter(place, lambda e: F.size(e["parts"]) < level)})
        deep = F.col(f"`{into}__deep`")
        above = lambda e: F.slice(e["parts"], 1, level - 1)  # noqa: B023, E731
        frame = frame.withColumn(f"{into}__tops", F.array_distinct(F.transform(deep, above)))

        def rebuilt(top: Column) -> Column:
            members = F.filter(deep, lambda e: above(e) == top)  # noqa: B023
            names = F.array_distinct(F.transform(members, lambda e: F.element_at(e["parts"], -1)))

            def member(name: Column) -> Column:
                same = F.filter(members, lambda e: F.element_at(e["parts"], -1) == name)
                return F.struct(name.alias("key"), last(same)["value"].alias("value"))

            value = F.to_variant_object(F.map_from_entries(F.transform(names, member)))
            return part(top, value, F.array_max(F.transform(members, lambda e: e["at"])))

        frame = frame.withColumn(into, F.concat(place, F.transform(F.col(f"`{into}__tops`"), rebuilt)))
        frame = frame.drop(f"{into}__deep", f"{into}__tops")
    whole = F.get(place, F.lit(0))["value"]
    empty = F.to_variant_object(F.map_from_entries(F.array().cast("array<struct<key:string,value:variant>>")))
    return frame.withColumn(into, F.when(own.isNotNull(), F.coalesce(whole, empty)))


def unmapped(frame: DataFrame, flat: str, names: str, into: str) -> DataFrame:
    """``frame`` with ``into``, the objects rebuilt from flat names and their paths of any length."""
    entries = _known_entries(F.col(f"`{flat}`"), F.col(f"`{names}`"))
    return unflattened(frame.withColumn(f"{into}__entries", entries), f"{into}__entries", into).drop(f"{into}__entries")
