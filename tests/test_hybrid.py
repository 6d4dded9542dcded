import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.operators import requests as request_module
from chunkloom.plans import search

WORDS = "to be or not the question is whether nobler in mind suffer".split()


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(120):
        text = " ".join(["the"] * 3 + list(rng.choice(WORDS, rng.integers(1, 30)))) + "!"
        text = None if i % 17 == 0 else "The, THE" if i % 13 == 0 else text
        vector = {"default": rng.normal(size=4).tolist()} if i % 5 else None
        rows.append((f"c{i:03d}", "f", text, f"t{i % 2}", None, i % 3, vector))
    chunks = spark.createDataFrame(
        rows,
        "chunk_id string, filename string, content string, tenant string, parent_id string, "
        "hierarchy_level int, embeddings map<string,array<float>>",
    ).repartition(3)
    asked = [
        ("a", "To be, or not to be?", rng.normal(size=4).tolist(), None, 0.5, None, None),
        ("b", "The question: nobler mind the the", rng.normal(size=4).tolist(), None, None, "t1", 2),
        ("c", "suffer unheard", rng.normal(size=4).tolist(), 0.9, 0.2, None, None),
    ]
    requests = spark.createDataFrame(
        asked,
        "request_id string, query_text string, query_embedding array<float>, horizon double, alpha double, "
        "tenant_name string, operation_level int",
    )
    return rows, asked, chunks, requests


def words(text):
    return [w for w in re.split(r"[^\w]+", text.lower()) if w]


def brute_bm25(rows, query, tenant):
    texts = {r[0]: words(r[2]) for r in rows if r[2] is not None and tenant in (None, r[3])}
    average = sum(map(len, texts.values())) / len(texts)
    scores = {}
    for term in set(words(query)):
        df = sum(term in t for t in texts.values())
        if df == 0:
            continue
        idf = math.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
        for chunk, text in texts.items():
            tf = text.count(term)
            if tf:
                damp = 1.2 * (0.25 + 0.75 * len(text) / average)
                scores[chunk] = scores.get(chunk, 0) + idf * tf * 2.2 / (tf + damp)
    return scores


def brute_hybrid(rows, request):
    _, text, vector, horizon, alpha, tenant, level = request
    alpha = 0.5 if alpha is None else alpha
    bm25 = brute_bm25(rows, text, tenant)
    q = np.array(vector, np.float32).astype(float)
    found = {}
    for r in rows:
        if tenant not in (None, r[3]) or (level is not None and r[5] != level):
            continue
        near = None
        if r[6]:
            v = np.array(r[6]["default"], np.float32).astype(float)
            near = q @ v / np.linalg.norm(q) / np.linalg.norm(v)
        score = bm25.get(r[0], 0)
        if horizon is None and (near is not None or score > 0) or horizon is not None and near is not None and 1 - near <= horizon:
            found[r[0]] = (near, score)

    def scaled(value, values):
        low, high = min(values), max(values)
        return 0 if value is None or high == low else (value - low) / (high - low)

    nears = [n for n, _ in found.values() if n is not None]
    texts = [t for _, t in found.values()]
    result = [
        (-round(alpha * scaled(n, nears) + (1 - alpha) * scaled(t, texts), 9), c) for c, (n, t) in found.items()
    ]
    return sorted(result)


@pytest.mark.parametrize("small", [True, False])
def test_hybrid_against_brute_force(data, small, monkeypatch):
    if not small:  # requests too big to broadcast
        monkeypatch.setattr(request_module, "SMALL_REQUESTS", 0)
    rows, asked, chunks, requests = data
    found = search.hybrid_search(chunks, requests, {"top": 25}, by_file=False).collect()
    for request in asked:
        mine = sorted((r for r in found if r["request_id"] == request[0]), key=lambda r: r["rank"])
        expected = brute_hybrid(rows, request)[:25]
        assert [r["chunk_id"] for r in mine] == [c for _, c in expected]
        assert [r["score"] for r in mine] == pytest.approx([-s for s, _ in expected], abs=1e-8)


@pytest.mark.parametrize("small", [True, False])
def test_bm25_against_brute_force(data, small, monkeypatch):
    if not small:
        monkeypatch.setattr(request_module, "SMALL_REQUESTS", 0)
    rows, asked, chunks, requests = data
    found = search.keyword_search(chunks, requests).collect()
    for request in asked:
        scores = brute_bm25(rows, request[1], request[5])
        level = {r[0]: r[5] for r in rows}
        tenant = {r[0]: r[3] for r in rows}
        expected = sorted(
            (-round(s, 9), c) for c, s in scores.items()
            if request[6] in (None, level[c]) and request[5] in (None, tenant[c])
        )
        mine = sorted((r for r in found if r["request_id"] == request[0]), key=lambda r: r["rank"])
        assert [r["chunk_id"] for r in mine] == [c for _, c in expected]
        assert [r["score"] for r in mine] == pytest.approx([-s for s, _ in expected], abs=1e-8)


def test_text_alone_is_embedded(data):
    _, _, chunks, requests = data
    texts = requests.drop("query_embedding").withColumn("horizon", F.lit(None).cast("double"))
    vectors = F.create_map(F.lit("default"), search.hashed_term_vector(F.col("content"), 64))
    found = search.hybrid_search(chunks.withColumn("embeddings", vectors), texts, {"top": 3}, by_file=False)
    assert {r["request_id"] for r in found.collect()} == {"a", "b", "c"}
