import json

import pytest
from conftest import CHILD, CHILD_VECTOR, PARENT, PARENT_VECTOR
from pyspark.sql import functions as F

from chunkloom.operators.regroup import documents_json, group_by_file
from chunkloom.operators.requests import profile, with_defaults
from chunkloom.plans import search


def request(spark, **params):
    kinds = {
        "query_embedding": "array<float>", "top": "int", "horizon": "double", "auto_limit": "int",
        "operation_level": "int", "include_vector": "boolean", "alpha": "double",
    }
    params = {"request_id": "r", **params}
    ddl = ", ".join(f"{k} {kinds.get(k, 'string')}" for k in params)
    return spark.createDataFrame([tuple(params.values())], ddl)


QUERY = PARENT_VECTOR


def test_parent_replaces_its_child(spark, simple_chunks):
    asked = request(
        spark, query_embedding=[1.4, 1.1], vector_name="coarse", method="l2-squared", operation_level=-1,
        parent_strategy="replace", include_vector=True, auto_limit=1, top=5,
    )
    (found,) = search.vector_search(simple_chunks, asked).collect()
    assert found["filename"] == "tides.md"
    (chunk,) = found["chunks"]
    assert (chunk["chunk_id"], chunk["is_parent"]) == (PARENT, True)
    assert chunk["embedding"] == pytest.approx(PARENT_VECTOR[:2])


@pytest.mark.parametrize(
    "having_all, having_any, found",
    [
        (None, {"custom_properties.gauge.name": "pier"}, [CHILD]),
        (None, {"custom_properties.metres >": 1, "document_metadata.language": "sv"}, [CHILD, PARENT]),
        ({"custom_properties.metres": 2, "document_metadata.source": "notes"}, None, []),
        ({"document_metadata.source": "almanac"}, {"custom_properties.metres <": 2}, []),
    ],
)
def test_filters(spark, simple_chunks, having_all, having_any, found):
    given = {"having_all": having_all, "having_any": having_any}
    texts = {k: json.dumps(v) for k, v in given.items() if v}
    rows = search.vector_search(simple_chunks, request(spark, query_embedding=QUERY, **texts), by_file=False)
    assert sorted(r["chunk_id"] for r in rows.collect()) == sorted(found)


def test_text_search_by_file(spark, simple_chunks):
    vectors = F.create_map(F.lit("default"), search.hashed_term_vector(F.col("content")))
    chunks = simple_chunks.withColumn("embeddings", vectors)
    found = search.text_search(chunks, request(spark, query_text="when is the water low")).collect()
    assert len(found) == 1 and len(found[0]["chunks"]) == 2
    assert found[0]["document_metadata"].toPython()["source"] == "almanac"
    child = next(c for c in found[0]["chunks"] if c["chunk_id"] == CHILD)
    assert child["hierarchy_level"] == 1 and child["parent_id"] == PARENT and child["embedding"] is None


def test_include_puts_parent_after_first_child(spark):
    rows = [
        ("root", None, 1.0), ("a", "root", 1.1), ("b", "root", 1.2), ("c", "gone", 1.3), ("other", None, 9.0),
        ("d", "other", 1.4),
    ]
    chunks = spark.createDataFrame(
        [(i, "f", "t", p, 0 if p is None else 1, {"default": [x, 1.0]}) for i, p, x in rows],
        "chunk_id string, filename string, tenant string, parent_id string, hierarchy_level int, embeddings map<string,array<float>>",
    )
    asked = request(spark, query_embedding=[1.0, 1.0], method="l2-squared", top=5, parent_strategy="include")
    found = search.vector_search(chunks, asked, by_file=False).orderBy("place").collect()
    assert [r["chunk_id"] for r in found] == ["root", "a", "root", "b", "c", "d", "other"]
    replaced = search.vector_search(
        chunks, asked.withColumn("parent_strategy", F.lit("replace")), by_file=False
    ).orderBy("place")
    assert [r["chunk_id"] for r in replaced.collect()] == ["root", "other"]


def test_defaults(spark):
    asked = request(spark, query_embedding=QUERY, method="", top=None, horizon=0.5)
    defaults = {"top": "5", "horizon": "0.9", "method": None, "alpha": "no number", "unknown": 3,
                "having_all": {"a": 1}, "vector_name": ""}
    row = with_defaults(asked, defaults).first()
    assert (row["top"], row["horizon"], row["method"], row["alpha"]) == (5, 0.5, "cosine", None)
    assert row["vector_name"] == "default" and row["include_vector"] is False
    assert json.loads(row["having_all"]) == {"a": 1}
    assert "unknown" not in row


def test_different_filters_share_one_scan(spark, simple_chunks):
    asked = request(spark, query_embedding=QUERY).union(
        request(spark, query_embedding=QUERY).withColumn("request_id", F.lit("s"))
    )
    level = F.when(F.col("request_id") == "s", 1)
    found = search.vector_search(simple_chunks, asked.withColumn("operation_level", level), by_file=False)
    assert sorted((r["request_id"], r["chunk_id"]) for r in found.collect()) == sorted(
        [("r", CHILD), ("r", PARENT), ("s", CHILD)]
    )


def test_many_filters_take_more_scans(spark, simple_chunks, monkeypatch):
    from chunkloom.operators import filters_by_request

    monkeypatch.setattr(filters_by_request, "MAX_SPECS", 2)
    rows = [(str(i), QUERY, i % 5 - 2) for i in range(10)]
    asked = spark.createDataFrame(rows, "request_id string, query_embedding array<float>, operation_level int")
    for tiles in (False, True):
        found = search.vector_search(simple_chunks, asked, by_file=False, in_tiles=tiles).collect()
        got = sorted((int(r["request_id"]), r["hierarchy_level"]) for r in found)
        want = sorted((i, {-2: 0, -1: 1, 0: 0, 1: 1}[i % 5 - 2]) for i in range(10) if i % 5 - 2 < 2)
        assert got == want


def test_big_documents_come_in_parts(spark):
    rows = [("r", "big", i * 2, f"c{i}") for i in range(100)] + [("r", "small", i * 2 + 1, f"s{i}") for i in (3, 90)]
    frame = spark.createDataFrame(rows, "request_id string, filename string, place bigint, chunk_id string").select(
        "*", F.lit("x").alias("content"), F.lit(0).alias("original_span_start"), F.lit(1).alias("original_span_end"),
        F.lit(0).alias("hierarchy_level"), F.lit(None).cast("string").alias("custom_properties"),
        F.lit(None).cast("string").alias("parent_id"), F.lit("t").alias("tenant"), F.lit(0.0).alias("distance"),
        F.lit(1).alias("rank"), F.lit(False).alias("is_parent"), F.concat(F.lit("m"), "place").alias("document_metadata"),
    )
    parts = group_by_file(frame, part_chunks=40).orderBy("filename", "part").collect()
    big = [p for p in parts if p["filename"] == "big"]
    assert len(big) == 3 and max(len(p["chunks"]) for p in big) <= 40
    assert [c["chunk_id"] for p in big for c in p["chunks"]] == [f"c{i}" for i in range(100)]
    small = [p for p in parts if p["filename"] == "small"]
    assert len(small) == 1 and [c["chunk_id"] for c in small[0]["chunks"]] == ["s3", "s90"]
    assert {(p["parts"], p["first_place"], p["document_metadata"]) for p in big} == {(3, 0, "m0")}
    assert len(group_by_file(frame).where("filename = 'big'").first()["chunks"]) == 100


@pytest.mark.parametrize("searching", [search.vector_search, search.keyword_search, search.hybrid_search])
def test_no_requests(spark, simple_chunks, searching):
    asked = request(spark, query_embedding=QUERY, query_text="noon", top=3).limit(0)
    assert searching(simple_chunks, asked).count() == 0


def test_profile_counts_filters(spark):
    big = json.dumps({"filename in": ["x" * 1000] * 200})
    batch = profile(with_defaults(request(spark, query_embedding=QUERY, having_all=big)))
    assert batch.bytes > len(big)


def test_result_json(spark, simple_chunks):
    found = search.vector_search(simple_chunks, request(spark, query_embedding=QUERY, include_vector=True))
    document = json.loads(documents_json(found).first()["document"])
    assert document["filename"] == "tides.md"
    assert document["document_metadata"] == {"language": "sv", "source": "almanac"}
    child = next(c for c in document["chunks"] if c["chunk_id"] == CHILD)
    assert child["original_span"] == [131, 152] and child["parent_id"] == PARENT
    assert child["custom_properties"] == {"gauge": {"name": "pier"}, "metres": 2}
    assert child["embedding"] == pytest.approx(CHILD_VECTOR)


def test_profile_bounds(spark):
    asked = with_defaults(request(spark, query_embedding=QUERY, top=3))
    batch = profile(asked.union(asked))
    assert (batch.count, batch.top, batch.max_hits) == (2, 3, 6)
    unbounded = profile(asked.union(asked.withColumn("top", F.lit(None).cast("int"))))
    assert unbounded.top is None and unbounded.max_hits is None and unbounded.limited_hits == 3


def test_contents_meet_hits_in_the_partition_of_their_file(spark, monkeypatch):
    """Equal to the join by id, with ids stored twice, files without a name, parents not stored and a crowded file."""
    rows = [(f"c{i % 17}", None if i % 7 == 0 else f"f{i % 5}", "t", f"c{i % 4}" if i % 3 else "gone", f"text {i}", [1.0, float(i)]) for i in range(40)]
    rows += [(None, "f1", "t", None, "no id", [1.0, 0.5])]
    chunks = spark.createDataFrame(
        [(i, f, t, p, x, 0, 0, len(x), {"default": v}, f or "none") for i, f, t, p, x, v in rows],
        "chunk_id string, filename string, tenant string, parent_id string, content string, hierarchy_level int, "
        "original_span_start bigint, original_span_end bigint, embeddings map<string,array<float>>, document_metadata string",
    ).withColumn("custom_properties", F.struct(F.length("content").alias("size")))
    asked = spark.createDataFrame(
        [(f"r{i % 9}", [1.0, float(i)], i % 2 == 0) for i in range(10)],
        "request_id string, query_embedding array<float>, include_vector boolean",
    )
    defaults = {"top": 6, "method": "l2-squared", "parent_strategy": "include"}

    def plain(documents):
        shown = documents.select("request_id", "filename", "first_place", "document_metadata", "part", "parts", "chunks")
        return sorted(str((*r[:-1], sorted(map(str, r[-1])))) for r in shown.collect())

    for part_chunks in (None, 2):
        # the parts of equal places may hold other hits
        searched = asked.where("request_id NOT IN ('r0', 'r3')") if part_chunks else asked
        stored = chunks.dropDuplicates(["chunk_id"]) if part_chunks else chunks
        stored = spark.createDataFrame(stored.collect(), stored.schema)
        expected = plain(search.vector_search(stored, searched, defaults, part_chunks=part_chunks))
        with monkeypatch.context() as patch:
            patch.setattr("chunkloom.operators.parents.BROADCAST_HITS", 0)
            patch.setattr("chunkloom.operators.parents.FILE_HITS", 4)
            found = search.vector_search(stored, searched, defaults, part_chunks=part_chunks)
            if part_chunks is None:
                assert "hashpartitioning(request_id" not in found._jdf.queryExecution().toString()
            assert plain(found) == expected
