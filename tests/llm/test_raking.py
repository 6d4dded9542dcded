import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import raking

ROWS = [
    (i, " ".join("w" for _ in range(5 + i % 17)) + (" mail@x" if i % 5 == 0 else ""), f"l{i % 3}", f"s{(i * i) % 4}", "clash")
    for i in range(200)
]
SCHEMA = "doc_id bigint, text string, lang string, source string, tokens string"


def fitted(rows, powers, rounds, budget):
    """The same fit on one array per dimension."""
    cells = {}
    for key in rows:
        cells[key[:3]] = cells.get(key[:3], 0) + key[3]
    names, tokens = list(cells), np.array(list(cells.values()), float)
    share = tokens / tokens.sum()
    goals = []
    for axis, power in enumerate(powers):
        values = {v: sum(t for n, t in cells.items() if n[axis] == v) ** power for v in {n[axis] for n in names}}
        goals.append({v: x / sum(values.values()) for v, x in values.items()})
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            sums = {v: sum(s for s, n in zip(share, names, strict=True) if n[axis] == v) for v in goal}
            share = np.array([s * goal[n[axis]] / sums[n[axis]] for s, n in zip(share, names, strict=True)])
    ratio = share * tokens.sum() / tokens
    low, high = 0.0, 1e6
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if (tokens * np.minimum(1, ratio * middle)).sum() < budget * tokens.sum() else (low, middle)
    return dict(zip(names, np.minimum(1, ratio * low), strict=True)), goals, dict(zip(names, share, strict=True))


def test_fit_and_draws(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = raking.sampling_plan(docs).collect()
    keys = [(r["source"], r["lang"], r["topic"], r["n_tokens"]) for r in found]
    expected, goals, share = fitted(keys, [0.5, 0.7, 0.5], raking.ROUNDS, raking.BUDGET)
    assert len(found) == len(ROWS)
    for row in found:
        assert row["probability"] == pytest.approx(expected[row["source"], row["lang"], row["topic"]], rel=1e-6)
        drawn = int(hashlib.md5(f"{raking.SEED}:{row['doc_id']}".encode()).hexdigest()[:13], 16) / 16**13
        assert row["kept"] == (drawn < row["probability"])
    for axis, goal in enumerate(goals):
        for value, target in goal.items():
            assert sum(s for n, s in share.items() if n[axis] == value) == pytest.approx(target, rel=0.02)
    kept = raking.sampled_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in found if r["kept"])


def test_given_targets(spark):
    cells = spark.createDataFrame([("a", "x", 90), ("a", "y", 10), ("b", "x", 50), ("b", "y", 50)], "source string, lang string, tokens bigint")
    wanted = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("absent", 9.0)], "source string, target double")
    even = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "lang string, target double")
    shares = raking.raked(cells, {"source": wanted, "lang": even}, rounds=60)
    assert {r[0]: round(r[1], 6) for r in shares.groupBy("source").agg(F.sum("share")).collect()} == {"a": 0.75, "b": 0.25}
    assert {r[0]: round(r[1], 6) for r in shares.groupBy("lang").agg(F.sum("share")).collect()} == {"x": 0.5, "y": 0.5}


def test_nulls_repeats_and_no_documents(spark):
    rows = [(None, None, None, None, None), (1, "a b", None, "s", None), (1, "a b", None, "s", None), (2, "", "l", "s", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = raking.sampling_plan(docs).collect()
    assert len(found) == 4
    assert {r["kept"] for r in found if r["doc_id"] == 1} in ({True}, {False})
    assert {(r["source"], r["lang"]) for r in found if r["doc_id"] is None} == {(raking.NONE, raking.NONE)}
    assert raking.sampling_plan(docs.limit(0)).count() == 0
    assert raking.sampled_documents(docs.limit(0)).count() == 0
