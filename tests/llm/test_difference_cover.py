import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import difference_cover as dc


def brute(docs, window):
    """Every window of every document against all that start earlier."""
    seen, out = set(), []
    for key, text in sorted(docs, key=lambda d: d[0]):
        words = (text or "").encode().split()
        gone = set()
        for start in range(len(words) - window + 1):
            own = tuple(words[start : start + window])
            if own in seen:
                gone |= set(range(start, start + window))
            seen.add(own)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_covers_have_every_difference():
    for period, cover in dc.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_two_places_share_an_anchor():
    for period in dc.COVERS:
        places = set(dc.anchor_places(200, period).tolist())
        for a in range(40):
            for b in range(40):
                assert any(a + d in places and b + d in places for d in range(period))


@pytest.mark.parametrize(("window", "period"), [(20, 13), (8, 7)])
def test_removal_is_brute_force(spark, monkeypatch, window, period):
    monkeypatch.setattr(dc, "SLICE_WORDS", 100)
    rng = random.Random(window)
    passages = [" ".join(rng.choice("abcd") for _ in range(n)) for n in (window - 1, window, window + 1, 3 * window, 90)]
    docs = []
    for i in range(120):
        parts = [" ".join(rng.choice("abcdefgh") + rng.choice(["", "\n"]) for _ in range(rng.randrange(40))) for _ in range(3)]
        docs.append((i, rng.choice(["", " "]).join(p for part in parts for p in (part, " " + rng.choice(passages) + " "))))
    docs += [(200, docs[3][1]), (201, docs[3][1]), (202, "  " + docs[3][1].replace("\n", " \t")), (203, None), (204, "a " * 500)]
    docs += [(205, "a " * 500), (206, "short text"), (207, "short text")]
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, n_words string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = dc.remove_repeats(frame, window, period).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, found)) == brute(docs, window)


def test_shared_and_missing_ids(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long), (1, long), (1, "x " + long), (None, long), (2, "y " + long), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((tuple(r)[:3] for r in dc.remove_repeats(frame).collect()), key=repr)
    ones = sorted(n for key, _, n in found if key == 1)
    # the two equal rows are one document; it and the other text of the id keep one of the passages
    assert ones in ([0, 0, 30], [0, 30, 30])  # the hash of the text decides which is first
    assert [f for f in found if f[0] == 2] == [(2, 31, 30)]
    assert [f[2] for f in found if f[0] is None] == [0, 0]
    assert dc.remove_repeats(frame.limit(0)).count() == 0


def test_text_that_is_kept(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    frame = spark.createDataFrame([(1, passage), (2, f"before {passage} behind")], "doc_id bigint, text string")
    rows = {r["doc_id"]: bytes(r["kept_text"]).decode() for r in dc.remove_repeats(frame, with_text=True).collect()}
    assert rows == {1: passage, 2: "before behind"}
    assert dc.covered_words(np.array([0]), 25, 20).sum() == 20


def test_many_texts_under_one_id(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    texts = [f"own{i} {passage} end{i}" for i in range(12)]
    frame = spark.createDataFrame([(1, t) for t in texts] + [(2, passage)], "doc_id bigint, text string").repartition(3)
    ties = [r[0] for r in frame.where("doc_id = 1").select(F.xxhash64(F.col("text").cast("binary"))).collect()]
    assert max(ties) - min(ties) >= 2**63  # their difference is no 64-bit number
    found = sorted(tuple(r)[:3] for r in dc.remove_repeats(frame).collect())
    # one of them, the first by its hash, keeps the passage
    assert found == [(1, 27, 0), *[(1, 27, 25)] * 11, (2, 25, 25)]
