import datetime

import pytest
from pyspark.sql import functions as F

from chunkloom.errors import InvalidFilter
from chunkloom.operators import predicates
from chunkloom.operators.predicates import compile_filter, like_pattern, split_key


@pytest.fixture(scope="module")
def typed(spark):
    return spark.createDataFrame(
        [
            ("a", 1, ("en", 5, ["x", "y"], datetime.datetime(2024, 1, 1), True, {"k": 1}, 2.5)),
            ("b", 2, ("nl", 7, ["z"], datetime.datetime(2024, 6, 1), False, {"k": 2}, 3.5)),
            ("c", 0, (None, None, None, None, None, None, None)),
        ],
        "chunk_id string, hierarchy_level int, custom_properties struct<`a  lang`:string, age:int, "
        "tags:array<string>, at:timestamp, flag:boolean, more:map<string,int>, score:double>",
    )


@pytest.fixture(scope="module")
def opened(spark):
    rows = [
        ("a", '{"lang": "en", "age": 5, "tags": ["x", 3], "deep": {"er": {"v": 1}}, "code": "12", "flag": true}'),
        ("b", '{"lang": "nl", "age": 7.5, "tags": "x", "code": 12, "none": null}'),
        ("c", "{}"),
    ]
    return spark.createDataFrame(rows, "chunk_id string, j string").select(
        "chunk_id", F.parse_json("j").alias("document_metadata")
    )


def ids(frame, having_all=None, having_any=None):
    kept = frame.where(compile_filter(frame.schema, having_all, having_any))
    return "".join(sorted(r["chunk_id"] for r in kept.collect()))


@pytest.mark.parametrize(
    "condition, expected",
    [
        ({"age": 5}, "a"),
        ({"age ==": 5}, "a"),
        ({"age !=": 5}, "b"),
        ({"age <": 7}, "a"),
        ({"age <=": 7}, "ab"),
        ({"age >": 5}, "b"),
        ({"age >=": 5.0}, "ab"),
        ({"tags contains": "x"}, "a"),
        ({"tags contains": ["x", "z", 12]}, "ab"),
        ({"age contains": [5, 6]}, "a"),
        ({"age in": [5, 7, "x"]}, "ab"),
        ({"age in": []}, ""),
        ({"age not-in": [5]}, "b"),
        ({"age not-in": []}, "ab"),
        ({"a  lang ~": "e*"}, "a"),
        ({"a  lang   !=": "en"}, "b"),
        ({"at >": "2024-03-01"}, "b"),
        ({"at <": datetime.datetime(2024, 3, 1)}, "a"),
        ({"flag": True}, "a"),
        ({"flag": 1}, ""),
        ({"age": "5"}, ""),
        ({"age": None}, ""),
        ({"more.k": 2}, "b"),
        ({"score >": 3}, "b"),
        ({"missing !=": 1}, ""),
        ({"missing not-in": [1]}, ""),
    ],
)
def test_struct_properties(typed, condition, expected):
    for prefix in ("custom_properties.", "custom_property."):
        assert ids(typed, {prefix + k: v for k, v in condition.items()}) == expected


@pytest.mark.parametrize(
    "condition, expected",
    [
        ({"lang": "en"}, "a"),
        ({"lang !=": "en"}, "b"),
        ({"age >": 5}, "b"),
        ({"age <=": 7.5}, "ab"),
        ({"tags contains": ["x"]}, "ab"),
        ({"tags contains": 3}, "a"),
        ({"deep.er.v": 1}, "a"),
        ({"code": 12}, "b"),
        ({"code": "12"}, "a"),
        ({"code in": ["12", 12]}, "ab"),
        ({"code not-in": [12]}, "a"),
        ({"none not-in": [1]}, ""),
        ({"none !=": 1}, ""),
        ({"flag": True}, "a"),
        ({"lang ~": "*l"}, "b"),
    ],
)
def test_variant_properties(opened, condition, expected):
    assert ids(opened, {"document_metadata." + k: v for k, v in condition.items()}) == expected


def test_fixed_column_and_json(typed):
    assert ids(typed, '{"hierarchy_level >=": 1}') == "ab"


def test_all_any_and_both(typed):
    lang, age = "custom_properties.a  lang", "custom_properties.age"
    assert ids(typed, {lang + " ==": "en", age + " ==": 7}) == ""
    assert ids(typed, None, {lang + " ==": "en", age + " ==": 7}) == "ab"
    assert ids(typed, {"chunk_id !=": "b"}, {lang + " ==": "en", age + " ==": 7}) == "a"


def test_no_filter_and_empty_filter(typed):
    assert compile_filter(typed.schema) is None
    assert compile_filter(typed.schema, "null", " ") is None
    with pytest.raises(InvalidFilter):
        compile_filter(typed.schema, {})


def test_keys_and_patterns():
    assert split_key("a space separated   attribute   !=") == ("a space separated   attribute", "!=")
    assert split_key("plain") == ("plain", "==")
    with pytest.raises(ValueError):
        split_key("age =~")
    assert like_pattern("50%_*\\") == "50\\%\\_%\\\\"


def test_filter_reaches_the_scan(spark, typed, tmp_path):
    path = str(tmp_path / "chunks")
    typed.write.parquet(path)
    stored = spark.read.parquet(path)
    kept = stored.where(compile_filter(stored.schema, {"custom_properties.age >=": 5})).select("chunk_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(custom_properties.age,5)" in plan
    assert "struct<chunk_id:string,custom_properties:struct<age:int>>" in plan


def test_large_integers_in_variants_are_exact(spark):
    large = 2**53
    rows = spark.createDataFrame([(str(n), f'{{"k": {n}}}') for n in (large, large + 1, 7.5)], "chunk_id string, j string")
    rows = rows.select("chunk_id", F.parse_json("j").alias("custom_properties"))
    schema = rows.schema

    def found(key, value):
        kept = rows.where(predicates.condition(schema, f"custom_properties.k{key}", value))
        return sorted(r["chunk_id"] for r in kept.collect())

    assert found("", large + 1) == [str(large + 1)]
    assert found(" >", large) == [str(large + 1)]
    assert found(" in", [large, 5]) == [str(large)]
    assert found(" <", 8) == ["7.5"]
