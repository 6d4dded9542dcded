import hashlib
import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.functions import properties as props
from chunkloom.functions.ids import uuid_column, uuid_list

NESTED = {"boat": {"name": "Elk", "hull": {"oak": True}}, "crew": 4}


def variants(spark, values):
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, j string").select("i", F.parse_json("j").alias("v"))


def paths(value, prefix=""):
    for key, below in value.items():
        path = f"{prefix}.{key}" if prefix else key
        if isinstance(below, dict):
            yield from paths(below, path)
        else:
            yield path, below


def test_flatten(spark):
    row = variants(spark, [NESTED]).select(props.flatten_variant(F.col("v")).alias("e")).first()
    found = {e["path"]: e["value"].toPython() for e in row["e"]}
    assert found == {"boat.name": "Elk", "boat.hull.oak": True, "crew": 4}


def test_of_equal_paths_the_last_counts(spark):
    frame = variants(spark, [{"hull": {"oak": 1}, "hull.oak": 2}])
    entries = props.flatten_variant(F.col("v"))
    row = frame.select(props.flat_properties(entries).alias("flat"), props.property_map(entries).alias("names")).first()
    assert [v.toPython() for v in row["flat"].values()] == [2]
    assert list(row["names"].values()) == ["hull.oak"]


def test_unflatten_keeps_types(spark):
    entry = "named_struct('path', '{}', 'value', CAST({} AS VARIANT))"
    given = [("a.day", "DATE'2024-05-06'"), ("a.real", "1.0D"), ("a.none", "NULL"), ("b", "12.50BD")]
    frame = spark.sql(f"SELECT array({', '.join(entry.format(*g) for g in given)}) AS e")
    back = frame.select(props.unflatten_properties(F.col("e")).alias("v"))
    kinds = back.select(*[F.schema_of_variant(F.variant_get("v", p, "variant")).alias(n) for n, p in
                          (("day", "$.a.day"), ("real", "$.a.real"), ("b", "$.b"))]).first()
    assert (kinds["day"], kinds["real"]) == ("DATE", "DOUBLE")
    assert kinds["b"].startswith("DECIMAL")


def test_flat_name(spark):
    row = spark.range(1).select(
        props.flat_name(F.lit("boat.name")).alias("a"),
        props.flat_name_of_parts(F.array(F.lit("boat"), F.lit("name"))).alias("b"),
    ).first()
    expected = "property_" + hashlib.md5(b"boat.name").hexdigest()
    assert row["a"] == row["b"] == expected


names = st.text("abcdé \"\\", min_size=1, max_size=4)
leaves = st.one_of(st.none(), st.booleans(), st.integers(-1000, 1000), st.text("xyz", max_size=3), st.lists(st.integers(0, 9), max_size=3))
objects = st.recursive(
    st.dictionaries(names, leaves, min_size=1, max_size=3),
    lambda inner: st.dictionaries(names, st.one_of(leaves, inner), min_size=1, max_size=3),
    max_leaves=8,
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(objects, min_size=20, max_size=30))
def test_flatten_and_back(spark, values):
    frame = variants(spark, values)
    entries = frame.select("i", "v", props.flatten_variant(F.col("v")).alias("e"))
    mapped = entries.select(
        "i", "e", props.unflatten_properties(F.col("e")).alias("back"),
        props.unmap_properties(props.flat_properties(F.col("e")), props.property_map(F.col("e"))).alias("unmapped"),
    )
    for row in mapped.collect():
        expected = values[row["i"]]
        assert {e["path"]: e["value"].toPython() for e in row["e"]} == dict(paths(expected))
        assert row["back"].toPython() == expected
        assert row["unmapped"].toPython() == expected


def test_later_value_wins_and_unknown_names_go(spark):
    entries = F.expr(
        "array(named_struct('path','a.b','value',1::variant), named_struct('path','c','value',2::variant),"
        " named_struct('path','a.b','value',3::variant))"
    )
    flat = F.expr("map('n1', 1::variant, 'n2', 2::variant)")
    names = F.expr("map('n1', 'x.y', 'n3', 'z')")
    row = spark.range(1).select(
        props.unflatten_properties(entries).alias("u"), props.unmap_properties(flat, names).alias("m")
    ).first()
    assert row["u"].toPython() == {"a": {"b": 3}, "c": 2}
    assert row["m"].toPython() == {"x": {"y": 1}}


def test_too_deep_raises(spark):
    deep = {"l": 1}
    for _ in range(8):
        deep = {"d": deep}
    with pytest.raises(Exception, match="nested deeper"):
        variants(spark, [deep]).select(props.flatten_variant(F.col("v"))).collect()


def test_struct_leaves_and_rebuild(spark):
    frame = spark.createDataFrame(
        [(("x", (1, None)),), ((None, (None, [1, 2])),)], "s struct<a:string, b:struct<c:int, d:array<int>>>"
    )
    kind = frame.schema["s"].dataType
    entries = props.flatten_properties(F.col("s"), kind)
    rows = frame.select(
        entries.alias("e"), props.rebuild_struct(F.map_from_entries(entries), kind).alias("back"), "s"
    ).collect()
    assert [[e["path"] for e in r["e"]] for r in rows] == [["a", "b.c"], ["b.d"]]
    assert all(r["back"] == r["s"] for r in rows)


def test_uuids(spark):
    good = "6BA7B810-9DAD-11D1-80B4-00C04FD430C8"
    frame = spark.createDataFrame([(good,), ("{6ba7b8109dad11d180b400c04fd430c8}",), (None,)], "u string")
    found = [r[0] for r in frame.select(uuid_column(F.col("u"))).collect()]
    assert found == [good.lower(), good.lower(), None]
    with pytest.raises(Exception, match="not a UUID"):
        spark.createDataFrame([("nope",)], "u string").select(uuid_column(F.col("u"))).collect()
    assert uuid_list(good) == [good.lower()]
    with pytest.raises(ValueError):
        uuid_list(["nope"])


def test_any_depth(spark):
    """Objects of different depths, in a column and in a field of a struct, there and back."""
    opened = "".join(f'{{"a{i}":' for i in range(20))
    texts = [f'{opened}{{"x": 1, "y": [1, {{"z": 2}}], "n": null}}{"}" * 20}', '{"a0": {"b": "text"}}', '{"c": 2.5}', "{}", None, "7"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = rows.select("id", F.parse_json("text").alias("v"))
    flat = props.flattened(rows, "v", "entries")
    found = {r["id"]: r["n"] for r in flat.select("id", F.size("entries").alias("n")).collect()}
    assert found == {0: 3, 1: 1, 2: 1, 3: 0, 4: 0, 5: 1}
    back = props.unflattened(flat.where("id < 3"), "entries", "back")
    same = back.select("id", F.to_json("v").alias("a"), F.to_json("back").alias("b")).collect()
    assert all(json.loads(r["a"]) == json.loads(r["b"]) for r in same)
    nested = rows.select("id", F.struct("id", F.struct("v").alias("in")).alias("s"))
    paths = props.flattened(nested.where("id = 0"), "s", "e").select(F.explode("e.path")).collect()
    assert max(len(r[0].split(".")) for r in paths) == 23
    assert props.flattened(rows.limit(0), "v", "entries").count() == 0
    assert props.unflattened(flat.limit(0), "entries", "back").count() == 0


def test_folding_is_the_expression(spark):
    """Both ways back give the same objects, also where a leaf and an object share a path."""
    paths = ["a", "a.b", "a.b.c", "d.e", "a.b", "d", "d.e.f", "g", "a.x", "g"]
    rng = random.Random(3)
    rows = [(i, [(rng.choice(paths), j) for j in range(rng.randrange(8))]) for i in range(60)]
    frame = spark.createDataFrame([*rows, (99, None)], "i int, e array<struct<path:string,value:int>>")
    frame = frame.withColumn("e", F.transform("e", lambda e: F.struct(e["path"].alias("path"), e["value"].cast("variant").alias("value"))))
    both = props.unflattened(frame, "e", "folded").withColumn("built", props.unflatten_properties(F.col("e")))
    for r in both.select("i", F.to_json("folded").alias("a"), F.to_json("built").alias("b")).collect():
        assert (r["a"] and json.loads(r["a"])) == (r["b"] and json.loads(r["b"])), rows[r["i"]] if r["i"] < 60 else None


def test_lonely_tails_are_built_at_once(spark):
    """Only parts that paths of a list share take a step of their own, however long the paths are."""
    deep = ".".join(f"p{i}" for i in range(40))
    frame = spark.createDataFrame(
        [(0, [(deep, 1)]), (1, [("a.b." + deep, 2), ("a", 3), ("a.c", 4)]), (2, [(deep, 5), (deep, 6)])],
        "i int, e array<struct<path:string,value:int>>",
    )
    frame = frame.withColumn("e", F.transform("e", lambda e: F.struct(e["path"].alias("path"), e["value"].cast("variant").alias("value"))))
    sizes = frame.select("i", F.transform(props._joints(F.col("e")), lambda p: F.size(p["parts"])).alias("n")).collect()
    assert {r["i"]: sorted(r["n"]) for r in sizes} == {0: [1], 1: [1, 2, 2], 2: [40, 40]}
    wanted = {0: {deep: 1}, 1: {"a.b." + deep: 2, "a.c": 4}, 2: {deep: 6}}
    for row in props.unflattened(frame, "e", "back").collect():
        assert dict(paths(row["back"].toPython())) == wanted[row["i"]]


def test_deep_events_are_the_work_of_all_tasks(spark, tmp_path):
    """One small file is read by one task; what is done with its rows is not."""
    from chunkloom.plans import queries

    rows = spark.range(40).select(F.col("id").alias("event_id"), F.lit('{"k": 7}').alias("props"))
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    events = queries._deep_events(spark, str(tmp_path), 3)
    assert events.rdd.getNumPartitions() == 4
    assert {r["k"] for r in queries.unflatten_deep(spark, str(tmp_path)).collect()} == {7}


def test_objects_are_told_without_their_whole_schema(spark):
    """The schema of a value walks all that lies below it, once more on every level."""
    values = [{"a": {}}, {"a": []}, {"a": None}, {"a": "OBJECT"}, {"a": {"b": 1}}, 7, None]
    frame = variants(spark, values)
    flat = props.flattened(frame, "v", "e")
    assert "schema_of_variant" not in flat._jdf.queryExecution().analyzed().toString()
    found = {r["i"]: r["o"] for r in frame.select("i", props.is_object(F.variant_get("v", "$.a", "variant")).alias("o")).collect() if r["i"] < 5}
    assert found == {0: True, 1: False, 2: False, 3: False, 4: True}
