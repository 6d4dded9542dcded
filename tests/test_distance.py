from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.functions.distance import distance
from chunkloom.operators import scoring
from chunkloom.operators.ranking import auto_cut_all, rank_all
from chunkloom.operators.requests import profile, with_defaults
from chunkloom.operators.scoring import pair_distance, screen
from chunkloom.plans import search
from chunkloom.plans.search import search_one, vector_search
from chunkloom.schema import METHODS


def brute(a, b, method):
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    if method == "cosine":
        scale = np.linalg.norm(a) * np.linalg.norm(b)
        return None if scale == 0 else 1 - a @ b / scale
    return {
        "dot": -(a @ b),
        "l2-squared": ((a - b) ** 2).sum(),
        "manhattan": np.abs(a - b).sum(),
        "hamming": float((a != b).sum()),
    }[method]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    values = rng.normal(size=(300, 12)).round(1).astype(np.float32)
    values[7] = 0
    values[20:60] = values[19]  # many copies of one vector
    values[100] *= 1e6
    return values


@pytest.fixture(scope="module")
def chunks(spark, vectors):
    rows = [
        (f"c{i:03d}", f"f{i % 9}", "t", None, i % 3, {"default": v.tolist()} if i % 11 else {"other": [1.0]})
        for i, v in enumerate(vectors)
    ]
    return spark.createDataFrame(
        rows,
        "chunk_id string, filename string, tenant string, parent_id string, hierarchy_level int, "
        "embeddings map<string,array<float>>",
    ).repartition(5)


@pytest.mark.parametrize("method", METHODS)
def test_column_distance(spark, vectors, method):
    pairs = spark.createDataFrame(
        [(vectors[i].tolist(), vectors[i + 1].tolist()) for i in range(30)],
        "a array<float>, b array<float>",
    )
    found = [r[0] for r in pairs.select(distance(F.col("a"), F.col("b"), method)).collect()]
    for i, value in enumerate(found):
        expected = brute(vectors[i], vectors[i + 1], method)
        assert (value is None) == (expected is None)
        assert expected is None or value == pytest.approx(expected, abs=1e-9, rel=1e-12)


@pytest.mark.parametrize("method", METHODS)
def test_screen_never_misses(vectors, method):
    m = vectors.astype(np.float64)
    rough, error = screen(m, m, method)
    for i in range(len(m)):
        exact = pair_distance(np.repeat(m[i : i + 1], len(m), 0), m, method)
        ok = ~np.isnan(exact)
        assert (rough[i][ok] - error[i] <= exact[ok]).all()


def expected_hits(vectors, query, method, top, horizon):
    found = []
    for i, v in enumerate(vectors):
        d = brute(query, v, method) if i % 11 else None
        if d is not None and (horizon is None or d <= horizon):
            found.append((round(d, 6), f"c{i:03d}"))
    return sorted(found)[:top]


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("in_tiles", [False, True])
def test_scan_against_brute_force(spark, vectors, chunks, method, in_tiles):
    tops, horizons = [3, 50, 7, 0], [None, 2.0, None, None]
    asked = [vectors[19], vectors[3], vectors[100] / 1e6, vectors[1]]
    requests = spark.createDataFrame(
        [(str(i), q.tolist(), method, tops[i], horizons[i]) for i, q in enumerate(asked)],
        "request_id string, query_embedding array<float>, method string, top int, horizon double",
    )
    rows = vector_search(chunks, requests, by_file=False, in_tiles=in_tiles).collect()
    for i, q in enumerate(asked):
        mine = sorted((r for r in rows if r["request_id"] == str(i)), key=lambda r: r["rank"])
        expected = expected_hits(vectors, q, method, tops[i], horizons[i])
        assert [r["chunk_id"] for r in mine] == [e[1] for e in expected]
        assert [r["distance"] for r in mine] == pytest.approx([e[0] for e in expected], abs=2e-6)
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))


@pytest.mark.parametrize("method", METHODS)
def test_one_request_as_plain_plan(spark, vectors, chunks, method):
    query = vectors[19].tolist()
    one = search_one(chunks, query, method, top=60, operation_level=-2)
    requests = spark.createDataFrame([("r", query)], "request_id string, query_embedding array<float>")
    defaults = {"method": method, "top": 60, "operation_level": -2}
    batch = vector_search(chunks, requests, defaults, by_file=False).orderBy("rank")
    assert [r["chunk_id"] for r in one.collect()] == [r["chunk_id"] for r in batch.collect()]
    assert "TakeOrderedAndProject" in one._jdf.queryExecution().executedPlan().toString()


def test_sizes_must_agree(spark, chunks):
    requests = spark.createDataFrame([("r", [1.0, 2.0])], "request_id string, query_embedding array<float>")
    with pytest.raises(Exception, match="different size"):
        vector_search(chunks, requests, by_file=False).collect()
    with pytest.raises(Exception, match="different size"):
        search_one(chunks, [1.0, 2.0]).collect()


def test_unknown_method(spark, chunks):
    requests = spark.createDataFrame(
        [("r", [1.0], "euclid")], "request_id string, query_embedding array<float>, method string"
    )
    with pytest.raises(ValueError, match="euclid"):
        vector_search(chunks, requests)


def test_no_requests(spark, chunks):
    none = spark.createDataFrame([], "request_id string, query_embedding array<float>")
    assert vector_search(chunks, none, by_file=False).count() == 0


def asked_for(spark, vectors, rows):
    """Completed requests: (number of the vector, top, auto_limit, horizon) each."""
    requests = spark.createDataFrame(
        [(f"r{i}", vectors[v].tolist(), "l2-squared", top, cut, far) for i, (v, top, cut, far) in enumerate(rows)],
        "request_id string, query_embedding array<float>, method string, top int, auto_limit int, horizon double",
    )
    return with_defaults(requests)


def listed(hits):
    return sorted((r["request_id"], r["rank"], r["chunk_id"], r["distance"]) for r in hits.collect())


def test_only_the_nearest_leave_a_task(spark, vectors, chunks, monkeypatch):
    asked = asked_for(spark, vectors, [(i, 3, None, None) for i in range(1, 11)])
    batch = profile(asked)
    monkeypatch.setattr(scoring, "BLOCK_CHUNKS", 4)
    monkeypatch.setattr(scoring, "BLOCK_REQUESTS", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = listed(search.ranked(search.nearest(chunks, asked, batch), batch))
    try:
        for partitions, pool in (("1", 1 << 20), ("6", 8)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            monkeypatch.setattr(scoring, "POOL_ROWS", pool)
            groups = scoring.request_groups(batch)
            assert groups == (1 if pool > 30 else 4)
            hits = search.nearest(chunks, asked, batch, in_tiles=True)
            assert hits.count() <= 30 * max(1, int(partitions) // groups)
            assert listed(search.ranked(hits, batch)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cut_in_steps_equals_cut_of_all_hits(spark, vectors, chunks, monkeypatch):
    monkeypatch.setattr(search, "FIRST_TOP", 2)
    monkeypatch.setattr(search, "TOP_STEP", 3)
    monkeypatch.setattr(search, "WINDOW_TOP", 20)  # some requests are left for the way of all hits
    rows = [(i, None, i % 4 + 1, None) for i in range(1, 9)]
    rows += [(12, None, 30, None), (13, None, 0, 40.0), (14, None, None, None), (15, 5, 2, None), (16, None, 2, 0.0)]
    rows += [(17, None, 1, -1.0)]  # no hit at all
    asked = asked_for(spark, vectors, rows)
    batch = profile(asked)
    found = listed(search.nearest_ranked(chunks, asked, batch))
    everything = search.nearest(chunks, asked, batch)
    assert found == listed(auto_cut_all(rank_all(everything), batch.auto_limit))
    assert {r[0] for r in found} == {f"r{i}" for i in range(len(rows) - 1)}


def test_unbounded_lists_are_ranked_where_they_are_scored(spark, vectors, chunks, monkeypatch):
    """Equal to Spark's sort with copies of chunks, ids without a value and ids of requests that come twice."""
    twice = chunks.where("chunk_id < '2'").unionByName(chunks.limit(3).withColumn("chunk_id", F.lit(None).cast("string")))
    stored = chunks.unionByName(twice)
    asked = asked_for(spark, vectors, [(i, None, None, 8.0 + i) for i in range(1, 30)] + [(40, None, None, -1.0)])
    asked = asked.unionByName(asked.where("request_id < 'r2'").withColumn("horizon", F.lit(25.0)))
    batch = profile(asked)
    everything = search.nearest(stored, asked, batch)
    expected = sorted(map(str, listed(rank_all(everything))))
    for rows in (1 << 23, 60):
        monkeypatch.setattr(scoring, "LISTED_ROWS", rows)
        monkeypatch.setattr(scoring, "HIT_BYTES", 10_000)
        found = search.nearest_ranked(stored, asked, batch)
        assert "rangepartitioning" not in found._jdf.queryExecution().toString()
        assert sorted(map(str, listed(found))) == expected
    monkeypatch.setattr(scoring, "LISTED_LONGEST", 5)  # too long for a task: the way of all hits
    assert sorted(map(str, listed(search.nearest_ranked(stored, asked, batch)))) == expected


def test_groups_of_unbounded_lists(spark, vectors):
    batch = replace(profile(asked_for(spark, vectors, [(1, None, None, 9.0)])), count=100_000, bytes=66_000_000)
    assert scoring.listed_groups(batch, 100_000, 800_000_000, 100_000, 48) == 96
    assert scoring.listed_groups(batch, 100_000, 800_000_000, 1 << 23, 48) is None
    assert scoring.listed_groups(batch, 100_000, 1_000_000, 100_000, 48) is None
    assert scoring.listed_groups(replace(batch, count=3, bytes=2_000), 100_000, 300_000, 100_000, 48) is None


def test_measures_of_all_hits(spark, vectors, chunks):
    asked = asked_for(spark, vectors, [(3, None, 1, None), (4, None, 1, 30.0)])
    batch = profile(asked)
    columns = ["tenant", "chunk_id", "parent_id", F.col("embeddings")["default"].alias("v0")]
    numbered = asked.withColumns({"slot": F.lit(0), "spec": F.lit(0)})
    measured = {r["request_id"]: tuple(r)[1:] for r in scoring.spreads(chunks.select(*columns), numbered, batch).collect()}
    hits = search.nearest(chunks, asked, batch).groupBy("request_id").agg(F.count("*"), F.min("distance"), F.max("distance"))
    assert measured == {r["request_id"]: tuple(r)[1:] for r in hits.collect()}


@pytest.mark.parametrize("spread", ["near", "far", "few", "one", "many"])
@pytest.mark.parametrize("method", ["manhattan", "hamming"])
def test_screens_are_off_by_their_bound_at_most(method, spread):
    rng = np.random.default_rng(5)
    q, c = rng.normal(size=(70, 24)), rng.normal(size=(900, 24))
    if spread == "far":
        c[3, 2] = 1e7
    elif spread == "few":
        q, c = rng.integers(0, 3, q.shape) * 1.0, rng.integers(0, 3, c.shape) * 1.0
    elif spread == "one":
        q, c = np.ones((70, 24)), np.ones((900, 24))
    elif spread == "many":
        q, c = rng.integers(0, 9, q.shape) * 1.0, rng.integers(0, 9, c.shape) * 1.0
    rough, error = scoring.screen(q, c, method)
    exact = np.array([scoring.pair_distance(np.repeat(q[i : i + 1], len(c), axis=0), c, method) for i in range(len(q))])
    assert (np.abs(rough - exact) <= error[:, None]).all()


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e30])
def test_cosine_is_screened_in_single_precision(scale):
    """Off by its bound at most, also for copies, near copies and opposite vectors; what is open is found."""
    rng = np.random.default_rng(6)
    q = rng.normal(size=(40, 64))
    c = np.concatenate([rng.normal(size=(300, 64)), q, -q, q + rng.normal(size=q.shape) * 1e-6]) * scale
    rough, error = scoring.quick_screen(q, c, "cosine")
    assert rough.dtype == np.float32
    exact = np.array([scoring.pair_distance(np.repeat(q[i : i + 1], len(c), axis=0), c, "cosine") for i in range(len(q))])
    assert (np.abs(rough - exact) <= error[:, None]).all()
    for cut in (0.0, 0.8, np.inf):
        i, j = scoring.within(rough, cut + error)
        found = set(zip(i.tolist(), j.tolist()))
        assert found >= set(zip(*(x.tolist() for x in np.nonzero(exact <= cut))))
    c[5] = 0
    assert 5 not in scoring.within(scoring.quick_screen(q, c, "cosine")[0], np.full(len(q), np.inf))[1]


def test_what_is_sent_grows_as_the_batch(spark, vectors):
    """Ten times the requests and chunks are met in as many slots and groups."""
    asked = profile(asked_for(spark, vectors, [(i, 10, None, None) for i in range(1, 11)]))
    shapes = []
    for times in (1_000, 10_000):
        batch = replace(asked, count=10 * times, bytes=6_400 * times, limited_hits=100 * times)
        assert not batch.is_shared
        shapes.append(scoring.tile_shape(batch, 10 * times, 48))
    assert shapes[0] == shapes[1]
    slots, groups = shapes[0]
    assert groups > slots > 1 and slots * groups <= 48
    many = replace(asked, count=10, bytes=6_400, limited_hits=100)
    assert many.is_shared and scoring.tile_shape(many, 10**9, 48) == (48, 1)


def test_more_partitions_do_not_make_more_tiles(spark, vectors, chunks):
    """Each tile is sent its requests and chunks, so tiles follow the cores, not the partitions of a larger input."""
    asked = asked_for(spark, vectors, [(i, 3, None, None) for i in range(1, 11)])
    batch = profile(asked)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    tiles, found = [], []
    try:
        for partitions in ("2", "8", "80"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            hits = search.nearest(chunks, asked, batch, in_tiles=True)
            tiles.append(hits.rdd.getNumPartitions())
            found.append(listed(search.ranked(hits, batch)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tiles[0] <= 2
    assert tiles[1] == tiles[2]
    assert tiles[2] <= scoring.TILES_PER_CORE * spark.sparkContext.defaultParallelism
    assert found[0] == found[1] == found[2]


def test_slots_and_groups_use_the_tiles(spark, vectors):
    """Where the requests need more than half as many groups as there are tiles, cores are not left without any."""
    batch = profile(asked_for(spark, vectors, [(i, 10, None, None) for i in range(1, 11)]))
    for needed in (1, 5, 13, 24, 30):
        large = replace(batch, count=52_000 * needed, bytes=640 * 52_000 * needed, limited_hits=520_000 * needed)
        groups = scoring.request_groups(large)
        slots, chosen = scoring.tile_shape(large, 52_000 * needed, 24)
        assert chosen >= groups and (slots * chosen <= 24 or (slots, chosen) == (1, groups))
        assert slots * chosen >= 20


def test_chunks_without_a_searched_vector_are_not_sent(spark, vectors, chunks, monkeypatch):
    counts, shape = [], scoring.tile_shape
    monkeypatch.setattr(scoring, "tile_shape", lambda batch, count, tiles: counts.append(count) or shape(batch, count, tiles))
    asked = asked_for(spark, vectors, [(i, 3, None, None) for i in range(1, 11)])
    batch = profile(asked)
    none = chunks.limit(40).withColumns(
        {"chunk_id": F.concat(F.lit("n"), "chunk_id"), "embeddings": F.lit(None).cast("map<string,array<float>>")}
    )
    expected = listed(search.ranked(search.nearest(chunks, asked, batch), batch))
    assert listed(search.ranked(search.nearest(chunks.unionByName(none), asked, batch, in_tiles=True), batch)) == expected
    assert counts == [sum(i % 11 > 0 for i in range(len(vectors)))]
    # of two named vectors, chunks with either stay
    both = profile(asked.withColumn("vector_name", F.when(F.col("request_id") < "r5", "other").otherwise("default")))
    scans = search._vector_scans(chunks.unionByName(none), asked, both)
    assert scans[0][0].count() == len(vectors)
