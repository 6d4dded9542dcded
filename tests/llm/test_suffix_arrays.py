import random
import re

import numpy as np
import pytest

from chunkloom.llm import suffix_arrays as sa

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, window):
    windows = [(str(k), words(t)) for k, t in items]
    out = []
    for key, text in docs:
        have, hit, found = words(text), set(), set()
        for item, own in windows:
            size = min(window, len(own))
            for start in range(len(own) - size + 1) if size else ():
                for at in range(len(have) - size + 1):
                    if have[at : at + size] == own[start : start + size]:
                        hit |= set(range(at, at + size))
                        found.add(item)
        out.append((key, len(have), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(have)))
    return sorted(out, key=repr)


def test_suffix_array_orders_all_suffixes():
    rng = np.random.default_rng(0)
    for size in (1, 2, 7, 60):
        words = rng.integers(0, 3, size)
        assert sa.suffix_array(words).tolist() == sorted(range(size), key=lambda i: words[i:].tolist())


@pytest.mark.parametrize("options", [{}, {"block_bytes": 60, "shard_words": 40}])
def test_contamination_is_brute_force(spark, options):
    rng = random.Random(3)
    vocabulary = ["a", "b", "C", "é", "Ü9"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ".", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 5, 9]))) for i in range(12)] + [(90, None), (91, "x y z"), (91, "x y z")]
    docs = [(i, text(rng.randrange(60))) for i in range(40)] + [(99, None), (100, ""), (None, "x y z"), (101, "a " * 5000)]
    docs += [(102, "q " * 200 + " x, Y. z! " + "q " * 60), (103, "q " * 30 + "x y z")]
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, n_words string").repartition(3)
    given = spark.createDataFrame([(*i, "clash") for i in items], "item_id bigint, text string, doc_id string")
    found = sa.contamination(frame, given, window=4, **options).collect()
    assert sorted(((r[0], r[1], r[2], r[3], r[5]) for r in found), key=repr) == brute(docs, items, 4)
    left = sa.clean_documents(frame, given, window=4, **options)
    assert left.columns == frame.columns
    assert sorted((r[0] for r in left.collect()), key=repr) == [k for k, *_, bad in brute(docs, items, 4) if not bad]


def test_longest_match_and_its_place(spark):
    docs = spark.createDataFrame([(1, "z z one two three four five z one two three")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "zero one two three four five six")], "item_id bigint, text string")
    (row,) = sa.find_matches(docs, items, window=3).collect()
    assert sorted(tuple(m) for m in row["matches"]) == [(7, 1, 2, 5), (7, 1, 8, 3)]


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert [tuple(r) for r in sa.contamination(docs, items).collect()] == [(1, 2, 0, [], 0, False)]
    assert sa.contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


@pytest.mark.parametrize("options", [{}, {"block_bytes": 8, "shard_words": 40}])
def test_every_text_is_judged_by_itself(spark, options):
    items = [(7, "x y z v"), (8, "one two three four"), (9, "p q r s")]
    docs = [(1, "x y z v one two three four"), (1, "x y z v one two three four"), (1, "long " * 500), (1, "p q r s " + "long " * 500)]
    docs += [(None, "a x y z v"), (None, "clean"), (None, "clean"), (None, None), (None, "")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    given = spark.createDataFrame(items, "item_id bigint, text string")
    found = sa.contamination(frame, given, window=4, **options).collect()
    assert sorted(((r[0], r[1], r[2], r[3], r[5]) for r in found), key=repr) == brute(docs, items, 4)
    left = sorted(map(tuple, sa.clean_documents(frame, given, window=4, **options).collect()), key=repr)
    assert left == sorted([*docs[2:4], *docs[5:]], key=repr)
