import pytest
from conftest import CHILD_VECTOR, PARENT
from pyspark.sql import functions as F

from chunkloom.errors import InvalidFilter
from chunkloom.operators import mutate
from chunkloom.operators.ingest import explode_documents

TYPES = (
    "tenant string, chunk_id string, filename string, content string, hierarchy_level int, "
    "document_metadata struct<language:string>, embeddings map<string,array<float>>"
)


@pytest.fixture(scope="module")
def target(spark):
    rows = [
        ("t1", "a", "f1", "old a", 0, ("en",), {"default": [1.0], "other": [2.0]}),
        ("t1", "b", "f1", "old b", 1, ("fr",), None),
        ("t2", "a", "f2", "old a2", 0, (None,), None),
    ]
    return spark.createDataFrame(rows, TYPES)


def contents(frame):
    return sorted((r["tenant"], r["chunk_id"], r["content"]) for r in frame.collect())


def test_upsert(spark, target):
    rows = [
        ("t1", "a", "f1", "first", 0, 0, {"default": [9.0]}),
        ("t1", "a", "f1", "last of level 0", 0, 2, {"default": [9.0]}),
        ("t1", "c", "f3", "deeper wins", 1, 0, None),
        ("t1", "c", "f3", "new c", 0, 9, None),
        ("t2", "b", "f3", "same id, other tenant", 0, 1, None),
    ]
    batch = spark.createDataFrame(
        rows, "tenant string, chunk_id string, filename string, content string, hierarchy_level int, "
        "position int, embeddings map<string,array<float>>",
    )
    for bound in (None, 10):
        after, counts = mutate.upsert(target, batch, bound)
        assert contents(after) == [
            ("t1", "a", "last of level 0"), ("t1", "b", "old b"), ("t1", "c", "deeper wins"),
            ("t2", "a", "old a2"), ("t2", "b", "same id, other tenant"),
        ]
        assert counts.first().asDict() == {"nr_inserts": 2, "nr_replaces": 1}
        replaced = after.where("tenant = 't1' AND chunk_id = 'a'").first()
        assert replaced["embeddings"] == {"default": [9.0]} and replaced["document_metadata"] is None
    with pytest.raises(Exception, match="exist already"):
        mutate.upsert(target, batch, replace=False)[1].collect()


def test_copies_of_one_id_are_combined_before_the_shuffle(spark):
    batch = spark.range(1000).select(
        F.lit("t").alias("tenant"), F.lit("hot").alias("chunk_id"), F.lit("f").alias("filename"),
        F.col("id").cast("string").alias("content"), F.lit(0).alias("hierarchy_level"), F.col("id").alias("position"),
    )
    kept = mutate.last_of_each(batch)
    assert kept.first()["content"] == "999"
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")


def test_deletes(spark, target):
    def check(result, left, matches):
        rows, counts = result
        assert contents(rows) == left
        assert counts.first().asDict() == {"matches": matches, "failed": 0, "successful": matches}

    a, b, a2 = ("t1", "a", "old a"), ("t1", "b", "old b"), ("t2", "a", "old a2")
    check(mutate.delete_by_id(target, ["a", "zzz"]), [b], 2)
    check(mutate.delete_by_ids(target, spark.createDataFrame([("t1", "a")], "tenant string, chunk_id string")), [b, a2], 1)
    check(mutate.delete_by_filename(target, "f1"), [a2], 2)
    # a chunk without the property never matches, so it stays
    check(mutate.delete_by_filter(target, {"document_metadata.language !=": "en"}), [a, a2], 1)
    check(mutate.delete_by_filter(target, None, {"filename": "f2", "document_metadata.language": "fr"}), [a], 2)
    with pytest.raises(InvalidFilter):
        mutate.delete_by_filter(target)
    with pytest.raises(InvalidFilter):
        mutate.delete_by_filter(target, {})


def test_delete_document(spark, target, documents):
    listed = documents.withColumn(
        "chunks", F.transform("chunks", lambda c: c.withField("chunk_id", F.lit("b")))
    )
    rows, counts = mutate.delete_document(target, listed)
    assert len(contents(rows)) == 2 and counts.first()["matches"] == 1


def test_explode(documents, other_documents):
    child = next(r for r in explode_documents(documents).collect() if r["hierarchy_level"] == 1)
    assert (child["original_span_start"], child["original_span_end"]) == (131, 152)
    assert child["document_metadata"].toPython() == {"language": "sv", "source": "almanac"}
    assert child["parent_id"] == PARENT and child["embeddings"]["default"] == CHILD_VECTOR
    second = explode_documents(other_documents, "named").collect()
    assert [r["position"] for r in second] == [0, 1, 2]
    assert all(r["embeddings"] is None for r in second)
    named = explode_documents(documents, "named").first()
    assert list(named["embeddings"]) == ["named"]
