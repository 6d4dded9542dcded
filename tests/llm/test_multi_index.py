"""Hard negatives against a plain search of all pairs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chunkloom.llm import multi_index as mi

SCHEMA = "vec_id bigint, label int, embedding array<float>, score string"


def brute(rows, anchors, n_positives=5, n_negatives=3, low=50, high=95):
    """``rows``: id, label and integers, each once."""
    out = []
    for own, label, vector in anchors:
        others = [(-sum(x * y for x, y in zip(vector, v, strict=True)), i, other) for i, other, v in rows if i != own]
        others.sort()
        for ps, positive in [(-s, i) for s, i, other in others if other == label][:n_positives]:
            fit = [(i, -s) for s, i, other in others if other != label and low * ps <= -100 * s <= high * ps]
            out += [(own, positive, k + 1, i, ps, s) for k, (i, s) in enumerate(fit[:n_negatives])]
    return sorted(out)


def integers(rows):
    seen = []
    for i, label, vector, *_ in rows:
        if i is not None and label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            row = (i, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector])
            if row not in seen:
                seen.append(row)
    return seen


@pytest.mark.parametrize(("codes", "block", "group"), [(None, 4096, 256), (5, 16, 3), (1, 7, 2)])
def test_search_is_brute_force(spark, monkeypatch, codes, block, group):
    monkeypatch.setattr(mi, "BLOCK_ROWS", block)
    monkeypatch.setattr(mi, "ANCHOR_ROWS", group)
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(7)] for _ in range(4)]
    rows = [(i, i % 3, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)], "clash") for i in range(150)]
    rows += [(200 + i, i % 2, centres[0], "hot") for i in range(40)]  # one vector, many ties
    rows += [(300, 1, [0.0] * 7, "zero"), (rows[0][0], *rows[0][1:]), (None, 1, centres[0], ""), (301, None, centres[0], "")]
    rows += [(302, 1, None, ""), (303, 1, [*centres[0][:6], None], ""), (304, 1, [*centres[0][:6], float("nan")], "")]
    rows += [(305, 1, [*centres[0][:6], float("inf")], ""), (306, 1, centres[0][:6], "short"), (307, 1, [], "")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    whole = mi.scaled(frame)
    found = mi.hard_negatives(whole, whole.where("vec_id % 5 = 0"), n_codes=codes)
    given = [r for r in integers(rows) if len(r[2]) == 7]
    assert sorted(map(tuple, found.collect())) == brute(given, [r for r in given if r[0] % 5 == 0])


def test_no_rows_and_lone_rows(spark):
    none = mi.scaled(spark.createDataFrame([], SCHEMA))
    assert mi.hard_negatives(none, none).count() == 0
    lone = mi.scaled(spark.createDataFrame([(0, 1, [1.0, 2.0], ""), (1, 2, [1.0, 2.0], "")], SCHEMA))
    assert mi.hard_negatives(lone, lone).count() == 0


def test_large_components_stay_exact(spark):
    big = float(2**23)
    rows = [(0, 1, [big, 1.0], ""), (1, 1, [big, 0.0], ""), (2, 2, [big * 0.75, 3.0], ""), (3, 2, [big * 0.75, 2.0], "")]
    whole = mi.scaled(spark.createDataFrame(rows, SCHEMA))
    given = integers(rows)
    found = sorted(map(tuple, mi.hard_negatives(whole, whole).collect()))
    assert found == brute(given, given)
    assert found[0][4] == 2**62


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-9, 9), max_size=6), st.lists(st.integers(-9, 9), max_size=6))
def test_cells_come_by_falling_bound(a, b):
    first, second = np.array(a, float), np.array(b, float)
    pairs = list(mi.falling_cells(first, second))
    assert sorted((i, j) for _, i, j in pairs) == [(i, j) for i in range(len(a)) for j in range(len(b))]
    sums = [s for s, *_ in pairs]
    assert sums == sorted(sums, reverse=True)
    assert all(s == first[i] + second[j] for s, i, j in pairs)


@settings(max_examples=100, deadline=None)
@given(st.integers(-1000, 1000))
def test_windows(score):
    low, high = mi.window_of(score, 50, 95)
    assert [s for s in range(-1100, 1100) if 50 * score <= 100 * s <= 95 * score] == list(range(low, high + 1))


def test_bounds_leave_cells_unread():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1000, (9, 8))
    vectors = np.floor(centres[rng.integers(0, 9, 900)] + rng.normal(0, 5, (900, 8))).astype(np.int64)
    books = tuple(mi.fit_centres(h, 3) for h in mi.halves(vectors.astype(float)))
    cell = mi.nearest(mi.halves(vectors.astype(float))[0], books[0]) * 3 + mi.nearest(mi.halves(vectors.astype(float))[1], books[1])
    order = np.argsort(cell, kind="stable")
    block = mi.Block(vectors[order], np.arange(900), np.zeros(900, np.int64), books)
    read = []
    scores = block.scores
    block.scores = lambda a, b, q: read.append(b - a) or scores(a, b, q)
    (bounds,) = mi._each(block, vectors[:1])
    best = mi.best_alike(block, vectors[0], -1, 0, 5, bounds)
    assert [-s for s, _ in best] == sorted((vectors @ vectors[0]).tolist(), reverse=True)[:5]
    assert sum(read) < 900 / 2
