import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.operators.ranking import auto_cut, auto_cut_all, rank_all, top_k


def hits(spark, top=None):
    rng = np.random.default_rng(3)
    rows = []
    for request in range(6):
        size = [0, 1, 2, 40, 3000, 25][request]
        for i in range(size):
            d = float(rng.choice([0.1, 0.5])) if request == 4 else float(rng.random())
            rows.append((f"r{request}", "t", f"c{i}", None, top, request % 3 + 1 if request else None, d))
    return spark.createDataFrame(
        rows, "request_id string, tenant string, chunk_id string, parent_id string, top int, auto_limit int, distance double"
    ).repartition(7)


def listed(frame):
    return sorted((r["request_id"], r["rank"], r["chunk_id"]) for r in frame.collect())


@pytest.mark.parametrize("top", [None, 10])
def test_rank_all_equals_window(spark, top):
    frame = hits(spark, top)
    wide = frame.withColumn("top", F.coalesce("top", F.lit(10_000)))
    assert listed(rank_all(frame)) == listed(top_k(wide, 10_000))


def groups_kept(distances, limit):
    """Walk the sorted distances and stop where group number ``limit`` would begin."""
    n = len(distances)
    if n < 2 or distances[-1] == distances[0]:
        return n
    bulge = [
        (d - distances[0]) / (distances[-1] - distances[0]) - i / (n - 1) for i, d in enumerate(distances)
    ]
    found = 0
    for i in range(1, n):
        if i < n - 1:
            starts = bulge[i] > bulge[i - 1] and bulge[i] > bulge[i + 1]
        else:
            starts = i >= 2 and bulge[i] > bulge[i - 1] and bulge[i] > bulge[i - 2]
        found += starts
        if found >= limit:
            return i
    return n


def test_auto_cut_both_ways(spark):
    frame = hits(spark).withColumn("top", F.lit(10_000))
    ranked = top_k(frame, 10_000)
    windowed, joined = listed(auto_cut(ranked)), listed(auto_cut_all(rank_all(frame), 3))
    assert windowed == joined
    by_request = {}
    for r in ranked.orderBy("request_id", "rank").collect():
        by_request.setdefault(r["request_id"], []).append((r["distance"], r["auto_limit"]))
    for request, rows in by_request.items():
        kept = groups_kept([d for d, _ in rows], rows[0][1])
        assert sum(1 for w in windowed if w[0] == request) == kept


def test_top_k_is_cut_before_each_shuffle(spark):
    plan = top_k(hits(spark, 5), 5)._jdf.queryExecution().executedPlan().toString()
    # before and behind the shuffle by request and group, and that by request
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("WindowGroupLimit") == 4
