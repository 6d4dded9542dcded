"""Document probability under a unigram model of subwords, summed over all segmentations.

The pieces are an existing vocabulary; their scores are learned here, from how often the vocabulary's
tokenizer uses each in the training documents (plus ``smoothing``). A text is its words in lower case
(ASCII letters), each behind a word mark, and one end. Its probability is the sum over all ways to cut
it into pieces: a forward recursion in log space over the lattice of pieces. No piece goes on over a
word mark, so the recursion runs word by word, and each distinct word is computed once. Characters that
no piece holds are spelled in byte pieces. All pieces and the end sum to one.

Spark's part. Words are counted per task before the shuffle into one table of distinct words. The
``frequent`` most common ones (at most that number) go to all tasks with their scores; the others meet
their documents in a join on the word.

Defined cases: a null text is empty, it has the end alone; a document with a null id is a training
document; rows that repeat an id and a text get the same result, each its own row; no training
documents leave every word unknown; extra columns do not matter. Memory: one text, or ``FLUSH`` words.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, binary_text, kept_in_process, lists, map_columns, text_digest
from chunkloom.operators.storage import staged

FREQUENT = 400_000
FLUSH = 400_000
SMOOTHING = 0.1
MARK = "▁"
_NOTHING = float("-inf")


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n_train, n_all`` of all documents (``training, text``)."""
    names = ["word", "n_train", "n_all"]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        train: Counter[bytes] = Counter()
        other: Counter[bytes] = Counter()

        def settled() -> Columns:
            rows = [(w, n, n + other.pop(w, 0)) for w, n in train.items()] + [(w, 0, n) for w, n in other.items()]
            train.clear()
            other.clear()
            return lists(rows, names)

        for batch in batches:
            for training, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (train if training else other).update(text.lower().split())
                if len(train) + len(other) > FLUSH:
                    yield settled()
        yield settled()

    counted = map_columns(docs.select("training", "text"), "word binary, n_train bigint, n_all bigint", worker)
    return counted.groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def piece_counts(words: DataFrame, model: str) -> DataFrame:
    """``piece, n``: how often the vocabulary's tokenizer uses each piece in the training words."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        from sentencepiece import SentencePieceProcessor

        tokenizer = SentencePieceProcessor(model_file=model)
        used: Counter[int] = Counter()
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            for ids, n in zip(tokenizer.encode(texts, num_threads=1), batch.column(1).to_pylist(), strict=True):
                for i in ids:
                    used[i] += n
        yield {"piece": list(used), "n": list(used.values())}

    counted = map_columns(words.where("n_train > 0").select("word", "n_train"), "piece int, n bigint", worker)
    return counted.groupBy("piece").agg(F.sum("n").alias("n"))


def learned_scores(used: dict[int, int], ends: int, model: str, smoothing: float) -> dict[str | int, float]:
    """log10 probability of every piece: by its text, byte pieces by their byte, the end by -1."""
    from sentencepiece import SentencePieceProcessor

    tokenizer = SentencePieceProcessor(model_file=model)
    weights: dict[str | int, float] = {-1: ends + smoothing}
    for i in range(tokenizer.get_piece_size()):
        if tokenizer.is_byte(i):
            weights[int(tokenizer.id_to_piece(i)[3:5], 16)] = used.get(i, 0) + smoothing
        elif not (tokenizer.is_control(i) or tokenizer.is_unknown(i) or tokenizer.is_unused(i)):
            piece = tokenizer.id_to_piece(i)
            if MARK not in piece[1:]:
                weights[piece] = used.get(i, 0) + smoothing
    for byte in range(256):  # a vocabulary without byte pieces gets them, so that every text has a score
        weights.setdefault(byte, smoothing)
    total = sum(weights.values())
    return {key: math.log10(weight / total) for key, weight in weights.items()}


class Lattice:
    """Marginal log10 probability of a word, over all segmentations."""

    def __init__(self, scores: dict[str | int, float]):
        self._bytes = [scores[b] for b in range(256)]
        self._tree: dict = {}  # a node has its next characters, and under None the score of its piece
        for piece, score in scores.items():
            if isinstance(piece, str):
                node = self._tree
                for character in piece:
                    node = node.setdefault(character, {})
                node[None] = score

    def __call__(self, word: bytes) -> float:
        text = MARK + word.decode("utf-8", "surrogateescape")
        size = len(text)
        forward = [_NOTHING] * size + [_NOTHING]
        forward[0] = 0.0
        for start in range(size):
            here = forward[start]
            spelled = sum(self._bytes[b] for b in text[start].encode("utf-8", "surrogateescape"))
            forward[start + 1] = log10_add(forward[start + 1], here + spelled)
            node = self._tree
            for end in range(start, size):
                node = node.get(text[end])
                if node is None:
                    break
                score = node.get(None)
                if score is not None:
                    forward[end + 1] = log10_add(forward[end + 1], here + score)
        return forward[size]


def log10_add(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if x - y > 17 else x + math.log10(1.0 + 10.0 ** (y - x))


def _scored_words(words: DataFrame, scores: dict[str | int, float]) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(scores)
    shared_key = uuid.uuid4().hex

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        lattice = kept_in_process("lattice", shared_key, lambda: Lattice(shared.value), beside=("words",))
        for batch in batches:
            yield {
                **{name: batch.column(i) for i, name in enumerate(("word", "n_train", "n_all"))},
                "score": [lattice(w) for w in batch.column(0).to_pylist()],
            }

    return map_columns(words, "word binary, n_train bigint, n_all bigint, score double", worker)


def _most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, as many whole steps of counts as ``most`` words allow.

    Counts are put on a scale of 16 steps to a doubling, so that the driver sees a thousand sizes at
    most and no task sorts all words.
    """
    step = F.floor(F.log2("n_all") * 16)
    sizes = words.groupBy(step.alias("step")).count().collect()
    least, taken = None, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        taken += row["count"]
        if taken > most:
            break
        least = row["step"]
    return words.where(F.lit(False) if least is None else step >= least)


def score_documents(
    docs: DataFrame,
    held_out: Column,
    model: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    frequent: int = FREQUENT,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per document.

    ``held_out`` says which rows nothing is learned from. ``base_score`` is the word model with one
    added to each count, ``score`` the lattice's log10 probability of the text.
    """
    spark = docs.sparkSession
    picked = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        text_digest(text_column).alias("tie"),
        binary_text(text_column).alias("text"),
    )
    counted, _ = staged(word_counts(picked.select((~F.col("held_out")).alias("training"), "text")), "words")
    totals = counted.agg(F.sum("n_train").alias("n"), F.sum(F.when(F.col("n_train") > 0, 1)).alias("v")).first()
    ends = picked.where("NOT held_out").count()
    tokens, distinct = (totals["n"] or 0) + ends, (totals["v"] or 0) + (ends > 0)
    # at most one row per piece of the vocabulary
    used = {r["piece"]: r["n"] for r in piece_counts(counted, model).collect()}
    scores = learned_scores(used, ends, model, smoothing)
    scored, _ = staged(_scored_words(counted, scores), "scored-words")

    spread = math.log10(tokens + distinct + 1)
    common = _most_frequent(scored, frequent).select("word", "n_train", "score").toArrow()
    shared = spark.sparkContext.broadcast(common)
    end = (math.log10(ends + 1) - spread, scores[-1], int(ends > 0))

    shared_key = uuid.uuid4().hex

    def known_words() -> dict[bytes, tuple[float, float, int]]:
        def read() -> dict[bytes, tuple[float, float, int]]:
            rows = zip(*(c.to_pylist() for c in shared.value.columns), strict=True)
            return {w: (math.log10(n + 1) - spread, s, int(n > 0)) for w, n, s in rows}

        return kept_in_process("words", shared_key, read, beside=("lattice",))

    id_type = docs.schema[id_column].dataType.simpleString()
    key = f"doc_id {id_type}, held_out boolean, tie binary"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        known = known_words()
        for batch in batches:
            rows = []
            for text in batch.column(3).to_pylist():
                words = Counter(text.lower().split())
                found = [(n, known[w]) for w, n in words.items() if w in known]
                rows.append((
                    words.total() + 1,
                    sum(n for n, k in found if k[2]) + end[2],
                    math.fsum(n * k[0] for n, k in found) + end[0],
                    math.fsum(n * k[1] for n, k in found) + end[1],
                ))
            yield {
                **{name: batch.column(i) for i, name in enumerate(("doc_id", "held_out", "tie"))},
                **lists(rows, ["n_tokens", "n_known", "base", "score"]),
            }

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        known = known_words()
        names = ("doc_id", "held_out", "tie", "word", "n")
        for batch in batches:
            rows = []
            for *row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = Counter(w for w in text.lower().split() if w not in known)
                rows += [(*row, w, n) for w, n in words.items()]
                if len(rows) > 100_000:
                    yield lists(rows, names)
                    rows = []
            yield lists(rows, names)

    whole = map_columns(picked, f"{key}, n_tokens bigint, n_known bigint, base double, score double", sums)
    left = map_columns(picked, f"{key}, word binary, n bigint", rare)
    left = left.join(scored.select("word", "n_train", F.col("score").alias("word_score")), "word").select(
        "doc_id",
        "held_out",
        "tie",
        F.lit(0).cast("bigint").alias("n_tokens"),
        F.when(F.col("n_train") > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * (F.log10(F.col("n_train") + 1.0) - spread)).alias("base"),
        (F.col("n") * F.col("word_score")).alias("score"),
    )
    every = whole.withColumn("rows", F.lit(1)).union(left.withColumn("rows", F.lit(0)))
    summed = every.groupBy("doc_id", "held_out", "tie").agg(
        *[F.sum(c).alias(c) for c in ("rows", "n_tokens", "n_known", "base", "score")]
    )
    # rows that repeat an id and a text were summed together
    one = summed.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    return one.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") / F.col("rows")).cast("bigint").alias("n_tokens"),
        (F.col("n_known") / F.col("rows")).cast("bigint").alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("score") / F.col("rows")).alias("score"),
    )


def held_out_seventh(id_column: str = "doc_id", remainder: int = 2) -> Column:
    """A seventh of the documents, by a checksum of the id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 7 == remainder
