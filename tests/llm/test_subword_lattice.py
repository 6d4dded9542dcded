import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from chunkloom.llm import subword_lattice as sl

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


def all_cuts(text, scores):
    """Probability by enumerating every segmentation."""
    if not text:
        return 1.0
    total = 0.0
    for end in range(1, len(text) + 1):
        if text[:end] in scores:
            total += 10 ** scores[text[:end]] * all_cuts(text[end:], scores)
    spelled = math.prod(10 ** scores[b] for b in text[0].encode("utf-8", "surrogateescape"))
    return total + spelled * all_cuts(text[1:], scores)


def test_forward_sum_is_all_segmentations():
    scores = sl.learned_scores({}, 3, MODEL, 0.1)
    assert math.isclose(sum(10**s for s in scores.values()), 1, rel_tol=1e-9)
    lattice = sl.Lattice(scores)
    for word in ("a", "the", "éß", "日本", "x" * 9, "\udcff"):
        exact = all_cuts(sl.MARK + word, scores)
        assert math.isclose(lattice(word.encode("utf-8", "surrogateescape")), math.log10(exact), rel_tol=1e-9)
    assert math.isfinite(lattice(b"long" * 20000))


@pytest.mark.parametrize("frequent", [0, 3, 1000])
def test_documents(spark, frequent):
    texts = ["The cat the CAT sat", "a dog sat on É é", "", None, "the  the\tthe", "unseen words here", "the cat"] * 3
    rows = [(i if i != 9 else None, t, "clash") for i, t in enumerate(texts)] + [(1, texts[1], "x"), (1, "other text", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string").repartition(3)
    found = sl.score_documents(docs, sl.held_out_seventh(), MODEL, frequent=frequent).collect()

    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    words = lambda t: (t or "").encode().lower().split()
    counts, ends = Counter(), 0
    for i, t, _ in rows:
        if not held(i):
            counts.update(words(t))
            ends += 1
    tokens, distinct = counts.total() + ends, len(counts) + 1
    used = Counter()
    tokenizer = SentencePieceProcessor(model_file=MODEL)
    for word, n in counts.items():
        for piece in tokenizer.encode(word.decode()):
            used[piece] += n
    scores = sl.learned_scores(used, ends, MODEL, sl.SMOOTHING)
    lattice = sl.Lattice(scores)
    expected = []
    for i, t, _ in rows:
        own = words(t)
        base = sum(math.log10((counts[w] + 1) / (tokens + distinct + 1)) for w in own)
        base += math.log10((ends + 1) / (tokens + distinct + 1))
        score = sum(lattice(w) for w in own) + scores[-1]
        expected.append((i, held(i), len(own) + 1, sum(w in counts for w in own) + 1, tokens, round(base, 8), round(score, 8)))
    rounded = [(*r[:5], round(r[5], 8), round(r[6], 8)) for r in found]
    assert sorted(rounded, key=repr) == sorted(expected, key=repr)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert sl.score_documents(docs, sl.held_out_seventh(), MODEL).count() == 0


def test_texts_of_one_id_with_one_32_bit_hash(spark):
    """Two texts that a 32-bit hash takes for one are scored each by itself, under one id as under two."""
    texts = ["w254943", "w267111"]
    assert len({r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("hash(t)").collect()}) == 1

    def scores(ids):
        docs = spark.createDataFrame([*zip(ids, texts, strict=True), (7, "other words")], "doc_id bigint, text string")
        found = sl.score_documents(docs, sl.held_out_seventh(), MODEL).where("doc_id IS NULL OR doc_id <> 7")
        return sorted(round(r["score"], 9) for r in found.collect())

    a, b = [i for i in range(20) if zlib.crc32(str(i).encode()) % 7 != 2][:2]  # none is held out
    assert scores([a, a]) == scores([None, None]) == scores([a, b])
    assert len(set(scores([a, a]))) == 2
