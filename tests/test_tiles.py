"""What large batches and unbounded lists write: nothing that grows with the number of pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chunkloom.operators import parents, scoring
from chunkloom.operators.requests import profile, with_defaults
from chunkloom.plans import search


@pytest.fixture
def stored(spark):
    """Chunks of which some are copies, some have no id and some no vector."""
    vectors = np.random.default_rng(11).normal(size=(60, 4)).round(2)
    rows = [(f"c{i}", "t", f"c{i // 3}", "text", vectors[i].tolist() if i % 7 else None) for i in range(60)]
    rows += [rows[5], rows[8], rows[8], (None, "t", None, "text", vectors[3].tolist()), ("c9", "t", None, "again", None)]
    frame = spark.createDataFrame(rows, "chunk_id string, tenant string, parent_id string, content string, v array<float>")
    vector = F.when(F.col("v").isNotNull(), F.create_map(F.lit("default"), "v"))
    return frame.withColumn("embeddings", vector).drop("v")


def asked_for(spark, rows):
    """(top, auto_limit, horizon) each."""
    vectors = np.random.default_rng(12).normal(size=(len(rows), 4)).round(2)
    requests = spark.createDataFrame(
        [(f"r{i}", vectors[i].tolist(), "l2-squared", *row) for i, row in enumerate(rows)],
        "request_id string, query_embedding array<float>, method string, top int, auto_limit int, horizon double",
    )
    return requests


def listed(rows):
    return sorted(map(str, rows.select("request_id", "rank", "chunk_id", "distance").collect()))


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_chunks_are_not_written_for_each_group(spark, stored):
    """A tile's partitions are read from where they were written once, however many groups there are."""
    frame = stored.select("tenant", "chunk_id", "parent_id", F.col("embeddings")["default"].alias("v0")).where("v0 IS NOT NULL")
    asked = with_defaults(asked_for(spark, [(2, None, None)] * 30)).withColumns({"slot": F.lit(0), "spec": F.lit(0)})
    batch = profile(asked)
    for listed_in in (None, 6):

        def process(requests, batches):
            pairs = sum(len(requests) * len(chunks) for chunks in batches)
            yield pa.RecordBatch.from_pydict({"pairs": pa.array([pairs], pa.int64())})

        tiles = scoring.over_blocks(frame, asked, batch, process, "pairs bigint", in_tiles=True, listed=listed_in)
        assert tiles.agg(F.sum("pairs")).first()[0] == 30 * frame.count()
        plan = plan_of(tiles)
        assert "CartesianProduct" in plan
        assert "Generate" not in plan  # no row is sent more than once


def test_long_lists_are_joined_where_they_are(spark, stored, monkeypatch):
    """Ids of chunks go to the hits, not hits to the chunks; with copies, ids without a value and parents."""
    asked = asked_for(spark, [(None, None, 4.0 + i) for i in range(20)])
    monkeypatch.setattr(scoring, "HIT_BYTES", 10_000)  # few pairs are few bytes
    monkeypatch.setattr(scoring, "LISTED_ROWS", 100)
    whole = listed(search.vector_search(stored, asked, by_file=False))
    found = search.vector_search(stored, asked, by_file=False, fields=())
    assert set(found.columns) == {"request_id", "tenant", "chunk_id", "distance", "rank", "place", "is_parent"}
    assert listed(found) == whole
    above = plan_of(found).split("CartesianProduct")[0]
    assert "BroadcastHashJoin" in above
    streamed = above[: above.index("MapInArrow")].split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in streamed
    for strategy in ("include", "replace"):
        wanted = asked.withColumn("parent_strategy", F.lit(strategy))
        some = search.vector_search(stored, wanted, by_file=False, fields=("content",))
        rows = search.vector_search(stored, wanted, by_file=False)
        assert sorted(map(str, some.select(sorted(some.columns)).collect())) == sorted(
            map(str, rows.select(sorted(some.columns)).collect())
        )
    monkeypatch.setattr(parents, "BROADCAST_CHUNKS", 0)  # too many ids for that
    assert listed(search.vector_search(stored, asked, by_file=False, fields=())) == whole


@pytest.mark.parametrize("count", [5, 70_000])
def test_order_within_lists(count):
    rng = np.random.default_rng(4)
    lists = rng.integers(0, count, 400).astype(np.int32)
    lists[:200] = count - 1
    distance = rng.choice([0.0, -0.0, 0.25, 0.5, *rng.random(50)], 400)
    place = rng.integers(0, 40, 400).astype(np.int32)
    ids = pa.table({"tenant": ["t", "u"] * 20, "chunk_id": [None if i % 9 == 0 else f"c{i // 2 * 7 % 40}" for i in range(40)]})
    order, starts = scoring.in_lists(lists, count, distance, place, ids)
    by_id = scoring.id_order(ids)
    expected = np.lexsort((by_id[place], distance, lists))
    assert [x[order].tolist() for x in (lists, distance, by_id[place])] == [x[expected].tolist() for x in (lists, distance, by_id[place])]
    assert starts[0] == 0 and starts[-1] == 400 and starts[count - 1] == (lists < count - 1).sum()


@pytest.mark.parametrize("twice", [False, True])
def test_cut_where_hits_are_scored(spark, stored, monkeypatch, twice):
    """Equal to the windows of Spark, with copies, lists without spread, empty ones and ids of requests that come twice."""
    rows = [(None, i % 4 + 1, None) for i in range(12)] + [(None, 30, None), (None, 2, 0.0), (None, 1, -1.0), (None, 1, 2.5)]
    asked = with_defaults(asked_for(spark, rows))
    if twice:
        asked = asked.unionByName(asked.where("request_id < 'r2'").withColumn("horizon", F.lit(5.0)))
    batch = profile(asked)
    monkeypatch.setattr(search, "FIRST_TOP", 2)
    monkeypatch.setattr(search, "TOP_STEP", 3)
    expected = listed(search.nearest_ranked(stored, asked, batch))
    monkeypatch.setattr("chunkloom.operators.requests.SHARED_HITS", 1)
    monkeypatch.setattr(scoring, "POOL_ROWS", 9)
    found = search.nearest_ranked(stored, asked, batch)
    assert listed(found) == expected
    monkeypatch.setattr(search, "WINDOW_TOP", 3)  # behind it only tasks look for a cut
    assert listed(search.nearest_ranked(stored, asked, batch)) == expected
    assert "rangepartitioning" not in plan_of(search.nearest_ranked(stored, asked, batch))
    monkeypatch.setattr(search, "LONGEST_CUT", 0)
    assert listed(search.nearest_ranked(stored, asked, batch)) == expected


def test_only_what_is_before_the_cut_leaves_a_task(spark, stored):
    columns = ["tenant", "chunk_id", "parent_id", F.col("embeddings")["default"].alias("v0")]
    frame = stored.select(*columns).where("v0 IS NOT NULL")
    asked = with_defaults(asked_for(spark, [(40, i % 3 + 1, None) for i in range(15)]))
    asked = asked.withColumns({"slot": F.lit(0), "spec": F.lit(0)})
    batch = profile(asked)
    told = asked.join(scoring.spreads(frame, asked.withColumn("top", F.lit(None).cast("int")), batch), "request_id")
    left = scoring.scan_cut(frame, told, batch)
    sent = left.groupBy("settled").count().collect()
    assert sum(r["count"] for r in sent if not r["settled"]) <= 15
    kept = left.where("settled").groupBy("request_id").agg(F.max("rank").alias("last"), F.count("*").alias("n")).collect()
    assert kept and all(r["last"] == r["n"] for r in kept)
    assert sum(r["n"] for r in kept) < 15 * 40 / 2
