import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import odd_sketch as od
from chunkloom.llm.common import WordIds


def shingles(text, width):
    words = (text or "").encode().lower().split()
    size = min(width, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(docs, width):
    sets = [shingles(t, width) for _, t in docs]
    group = list(range(len(docs)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return sorted(
        ((k, len(sets[i]), least.get(top(i)), k == least.get(top(i))) for i, (k, _) in enumerate(docs)), key=repr
    )


@pytest.mark.parametrize("similarity", [0.8, 0.9, 0.79])
def test_no_link_is_screened_out(similarity):
    rng = np.random.default_rng(1)
    for size in (5, 30, 300, 990, 1005, 3000, 30000):
        for _ in range(20):
            values = rng.integers(0, 2**63, size, dtype=np.uint64)
            shared = -int(-similarity * size // 1)
            cut = shared + (size - shared) // 2
            sets = [np.unique(values[:cut]), np.unique(np.concatenate([values[:shared], values[cut:]]))]
            members = od.Members([len(s) for s in sets], *zip(*[od.sketches(s)[1:] for s in sets]), [od.sketches(s)[0] for s in sets])
            near, _ = members.near(np.array([0]), members, np.array([1]), 0.8)
            assert near[0] or shared < 0.8 * size


def test_far_pairs_are_screened_out():
    rng = np.random.default_rng(2)
    for size in (100, 5000):
        values = rng.integers(0, 2**63, size, dtype=np.uint64)
        sets = [np.unique(values[: size * 17 // 20]), np.unique(values[size * 3 // 20 :])]  # similarity 0.7
        members = od.Members([len(s) for s in sets], *zip(*[od.sketches(s)[1:] for s in sets]), [od.sketches(s)[0] for s in sets])
        near, _ = members.near(np.array([0]), members, np.array([1]), 0.8)
        assert not near[0]


def test_short_texts_are_one_shingle():
    ids = WordIds()
    assert len(od.shingle_set([], 4, ids)) == 0
    assert len(od.shingle_set([b"a"], 4, ids)) == len(od.shingle_set([b"a", b"b", b"c"], 4, ids)) == 1


@pytest.mark.parametrize("block", [1000, 5])
def test_groups_are_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(od, "BLOCK", block)
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs = []
    for base in [text(rng.choice([5, 30, 120, 400])) for _ in range(12)]:
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(copy)
    chain = text(200)  # neighbours are near, ends are not
    for step in range(12):
        docs.append(chain[5 * step : 5 * step + 130])
    rng.shuffle(docs)
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    docs += [(500, docs[0][1].upper()), (501, docs[0][1] + " "), (502, ""), (503, None), (504, " \n"), (505, "one two"), (506, "ONE two")]
    docs += [(None, docs[1][1]), (None, "alone and without an id")]
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, node string").repartition(3)
    found = od.near_duplicates(frame, width=4).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, 4)


def test_one_of_each_and_empty_tables(spark):
    rows = [(1, "a b c d e f", 6), (2, "a b c d e f", 7), (3, None, None), (3, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, kept int")
    left = od.one_of_each(frame, width=5)
    assert left.columns == frame.columns
    assert sorted(r[0] for r in left.collect()) == [1, 3, 3]
    assert od.near_duplicates(frame.where(F.lit(False))).count() == 0


def test_one_text_of_each_group_whatever_the_ids(spark):
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([*base, f"end{i}"]) for i in range(3)]
    rows = [(None, near[0]), (None, near[1]), (None, near[1]), (None, "alone and without an id"), (None, None), (None, "")]
    rows += [(5, "x " + near[0][::-1]), (5, "y " + near[0][::-1]), (5, "another text of the same id"), (6, "z " + near[0][::-1])]
    rows += [(7, "a row that is there twice"), (7, "a row that is there twice")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = od.one_of_each(frame)
    assert left.columns == frame.columns
    left = [tuple(r) for r in left.collect()]
    assert sum(text in near for _, text in left) == 1
    assert sum(text in (rows[6][1], rows[7][1]) and key == 5 for key, text in left) == 1
    others = sorted((r for r in left if r[1] not in (*near, rows[6][1], rows[7][1])), key=repr)
    assert others == sorted([*rows[3:6], rows[8], rows[10]], key=repr)
