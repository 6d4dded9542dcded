"""The coarse screen of manhattan distances: what it closes is farther than the cut."""

import numpy as np
import pyarrow as pa
import pytest

from chunkloom.operators import scoring


def drawn(spread):
    rng = np.random.default_rng(21)
    q, c = rng.normal(size=(40, 24)), rng.normal(size=(3_000, 24))
    if spread == "far":
        c[5], c[2_900, 3], q[2, 7] = 1e9, -1e6, 1e7
    elif spread == "no number":
        c[7, 2], c[8, 3], c[9, 4], q[3, 1] = np.nan, np.inf, -np.inf, np.nan
    elif spread == "few":
        q, c = rng.integers(0, 3, q.shape) * 1.0, rng.integers(0, 3, c.shape) * 1.0
    elif spread == "one":
        q, c = np.full(q.shape, 3.0), np.full(c.shape, 3.0)
    elif spread == "small":
        q, c = q * 1e-30, c * 1e-30
    elif spread == "shifted":
        q, c = q + 1e9, c + 1e9
    elif spread == "heavy":
        q, c = q**9, c**9
    elif spread == "wide":
        q, c = rng.normal(size=(20, 3_000)), rng.normal(size=(400, 3_000))
    c[11] = q[0]
    return q, c


def exact(q, c):
    return np.array([scoring.pair_distance(np.repeat(q[i : i + 1], len(c), axis=0), c, "manhattan") for i in range(len(q))])


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
@pytest.mark.parametrize("spread", ["near", "far", "no number", "few", "one", "small", "shifted", "heavy", "wide"])
def test_nothing_near_is_closed(spread, monkeypatch):
    monkeypatch.setattr(scoring, "_USEFUL", 2.0)
    monkeypatch.setattr(scoring, "_COARSE_TILE", 7_000)
    q, c = drawn(spread)
    gaps, distance = scoring.CoarseGaps(c), exact(q, c)
    assert gaps.suits() == (spread != "one")
    if not gaps.suits():
        return
    for nth in (1, 20, len(c) // 2, len(c) - 1):
        cut = np.sort(distance, axis=1)[:, nth]
        cut = np.where(np.isfinite(cut), cut, 1.0)
        for start, stop in ((0, len(c)), (3, 300)):
            i, j = gaps.near(q, start, stop, cut)
            found = set(zip(i.tolist(), j.tolist()))
            assert len(found) == len(i)
            needed = np.nonzero(distance[:, start:stop] <= cut[:, None])
            assert found >= set(zip(*(x.tolist() for x in needed)))
    if spread == "near":  # and it closes nearly all that is not near
        cut = np.sort(distance, axis=1)[:, 10]
        assert len(gaps.near(q, 0, len(c), cut)[0]) < 5 * 11 * len(q)


def nearest(q, c, top, chunks_at_once):
    """Hits by way of blocks, as tasks score them."""
    listed = lambda m: pa.array([v.tolist() for v in m], pa.list_(pa.float64()))
    n = len(q)
    requests = pa.table(
        {
            "request_id": [f"r{i}" for i in range(n)], "query_embedding": listed(q), "slot": pa.array([0] * n, pa.int32()),
            "method": ["manhattan"] * n, "top": pa.array([top] * n, pa.int32()), "auto_limit": pa.nulls(n, pa.int32()),
            "horizon": pa.nulls(n, pa.float64()), "spec": pa.array([0] * n, pa.int32()),
        }
    )
    ids = pa.array([f"c{i:06d}" for i in range(len(c))])
    chunks = pa.table({"tenant": pa.array(["t"] * len(c)), "chunk_id": ids, "parent_id": ids, "v0": listed(c)})
    block = scoring.RequestBlock(requests)
    parts = (chunks.slice(at, chunks_at_once) for at in range(0, len(c), chunks_at_once))
    found = scoring.collect_hits(block, (hit for part in parts for hit in scoring.score(block, part)))
    return sorted((int(r["request_id"][1:]), r["distance"], r["chunk_id"]) for b in found for r in b.to_pylist())


@pytest.mark.parametrize("spread", ["near", "few", "far"])
def test_hits_are_those_of_all_distances(spread, monkeypatch):
    q, c = drawn(spread)
    tried, near = [], scoring.CoarseGaps.near
    monkeypatch.setattr(scoring.CoarseGaps, "near", lambda *a: tried.append(near(*a)) or tried[-1])
    found = nearest(q, c, 300, 500)
    distance = exact(q, c)
    ids = np.arange(len(c))
    expected = [(i, distance[i, k], f"c{k:06d}") for i in range(len(q)) for k in np.lexsort((ids, distance[i]))[:300]]
    assert found == expected
    assert tried  # from the first blocks on, which fill the lists
