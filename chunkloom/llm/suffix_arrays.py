"""Benchmark decontamination by suffix arrays over the training documents.

Tasks cut their documents into shards, build a suffix array of each shard's words and look every
suffix of the test items up by binary search; what they find are longest verbatim matches with their
places. Only stretches of a document in which every pair of neighbours also stands in a test item can
hold a match, so only these enter the array, whole.

A window is ``window`` consecutive words of an item; an item of fewer words is one window. A document
word inside an occurrence of a window is hit.

Test items are read in blocks of about ``block_bytes``; each block is one pass over the documents, so
that what tasks and driver hold at once has that bound however large the test set is.

Defined cases: null texts have no words and hit nothing; an item without words is no window; repeated
items each count with their own id; every row is judged by its own text and has its own result, also
if its id is null or repeated; no items leave all documents clean. Of the inputs only the ids and texts
are read. Memory: one shard of ``shard_words`` words, or one longer document.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, binary_text, lists, map_columns, text_digest

WINDOW = 13
SHARE = 20  # contaminated: at least one word in so many is hit
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20

# Words are runs of letters and digits; ASCII letters lose their case, all other bytes of ASCII separate.
_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class TestSet:
    """Test items as word numbers, with the pairs of neighbours they contain."""

    __test__ = False

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.items: list[tuple[object, np.ndarray]] = []
        for key, text in items:
            words = words_of(text)
            if words:
                ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
                self.items.append((key, np.array(ids, np.int64)))
        self.window = window
        self.shortest = min((min(len(i), window) for _, i in self.items), default=0)
        pairs = [i[:-1] << 32 | i[1:] for _, i in self.items]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        bits = 20
        self._filter = np.zeros(1 << bits, bool)  # most pairs of a document are told apart by this
        self._shift = np.uint64(64 - bits)
        self._filter[self._slot(self.pairs)] = True

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift

    def has_pair(self, pairs: np.ndarray) -> np.ndarray:
        found = self._filter[self._slot(pairs)]
        maybe = np.flatnonzero(found)
        if len(maybe):
            at = np.searchsorted(self.pairs, pairs[maybe])
            found[maybe] = self.pairs[np.minimum(at, len(self.pairs) - 1)] == pairs[maybe]
        return found

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Longest runs of known words whose neighbours are all pairs of the test set."""
        if not len(ids) or not self.shortest:
            return
        known = ids > 0
        joined = np.zeros(len(ids) + 1, bool)
        if len(ids) > 1 and len(self.pairs):
            both = np.flatnonzero(known[:-1] & known[1:])
            joined[both[self.has_pair(ids[both] << 32 | ids[both + 1])] + 1] = True
        starts = np.flatnonzero(known & ~joined[:-1])
        ends = np.flatnonzero(known & ~joined[1:]) + 1
        for i in np.flatnonzero(ends - starts >= self.shortest):
            yield int(starts[i]), int(ends[i])


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the length that ranks compare."""
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    width, count = 1, len(words)
    while True:
        behind = np.full(count, -1, np.int64)
        behind[: count - width] = rank[width:] if width < count else []
        order = np.lexsort((behind, rank))
        first, second = rank[order], behind[order]
        new = np.concatenate([[0], np.cumsum((first[1:] != first[:-1]) | (second[1:] != second[:-1]))])
        rank = np.empty(count, np.int64)
        rank[order] = new
        width *= 2
        if new[-1] == count - 1 or width >= count:
            return order


class Shard:
    """Stretches of several documents, one after the other, each closed by a word of no item."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.places: list[tuple[int, int, int]] = []  # start in the shard, document, start in it
        self.size = 0

    def add(self, document: int, start: int, words: np.ndarray) -> None:
        self.places.append((self.size, document, start))
        self.parts += [words, np.zeros(1, np.int64)]
        self.size += len(words) + 1

    def matches(self, test: TestSet) -> Iterator[tuple[int, int, int, int, int]]:
        """``document, its start, item, its start, length`` of every match that cannot be longer."""
        if not self.parts:
            return
        words = np.concatenate(self.parts)
        order = suffix_array(words).tolist()
        text = words.astype(">i4").tobytes()
        begins = [p[0] for p in self.places]
        for number, (_, item) in enumerate(test.items):
            needed = min(test.window, len(item))
            pattern = item.astype(">i4").tobytes()
            for start in range(len(item) - needed + 1):
                wanted = pattern[4 * start : 4 * (start + needed)]
                prefix = lambda at: text[4 * at : 4 * (at + needed)]  # noqa: E731, B023
                low = bisect_left(order, wanted, key=prefix)
                if low == len(order) or prefix(order[low]) != wanted:
                    continue
                high = bisect_right(order, wanted, low, key=prefix)
                for at in order[low:high]:
                    if start and at and words[at - 1] == item[start - 1]:
                        continue  # the match that begins one word earlier holds this one
                    length = needed
                    while start + length < len(item) and words[at + length] == item[start + length]:
                        length += 1
                    shard_start, document, own_start = self.places[bisect_right(begins, at) - 1]
                    yield document, own_start + at - shard_start, number, start, length


_MATCHES = "array<struct<item:{item},item_start:bigint,doc_start:bigint,length:bigint>>"


def _blocks(items: DataFrame, id_column: str, text_column: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The test items, a block of about ``block_bytes`` after the other on the driver."""
    picked = items.select(F.col(id_column).alias("item"), binary_text(text_column).alias("text"))
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    for block in range(count):
        part = picked.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block) if count > 1 else picked
        yield [(r["item"], bytes(r["text"])) for r in part.collect()]


def _passes(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> list[DataFrame]:
    """``doc_id, digest, n_words, matches`` for each block of test items: one row per document."""
    picked = docs.select(
        F.col(id_column).alias("doc_id"), text_digest(text_column).alias("digest"), binary_text(text_column).alias("text")
    )
    id_type = docs.schema[id_column].dataType.simpleString()
    item_type = items.schema[item_column].dataType.simpleString()
    ddl = f"doc_id {id_type}, digest binary, n_words bigint, matches {_MATCHES.format(item=item_type)}"
    passes = []
    for block in _blocks(items, item_column, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def worker(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[Columns]:
            test = TestSet(shared.value, window)
            number = test.numbers.get

            def settled(keys: list, digests: list, counts: list, shard: Shard) -> Columns:
                matches: list[list[dict]] = [[] for _ in keys]
                for document, at, item, start, length in shard.matches(test):
                    row = {"item": test.items[item][0], "item_start": start, "doc_start": at, "length": length}
                    matches[document].append(row)
                return {"doc_id": keys, "digest": digests, "n_words": counts, "matches": matches}

            keys, digests, counts, shard, read = [], [], [], Shard(), 0
            for batch in batches:
                for key, digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    words = words_of(text)
                    if keys and read + len(words) > shard_words:
                        yield settled(keys, digests, counts, shard)
                        keys, digests, counts, shard, read = [], [], [], Shard(), 0
                    ids = np.fromiter((number(w, 0) for w in words), np.int64, len(words))
                    for start, end in test.stretches(ids):
                        shard.add(len(keys), start, ids[start:end])
                    keys.append(key)
                    digests.append(digest)
                    counts.append(len(words))
                    read += len(words)
            if keys:
                yield settled(keys, digests, counts, shard)

        passes.append(map_columns(picked, ddl, worker))
    return passes


def find_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """``doc_id, n_words, matches``: one row per document and block of test items."""
    return reduce(DataFrame.union, _passes(docs, items, window, **options)).drop("digest")


def _judged(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE, **options) -> DataFrame:
    """What :func:`contamination` gives, and the ``digest`` of the text."""
    spans = F.transform("matches", lambda m: F.struct(m["doc_start"].alias("a"), (m["doc_start"] + m["length"]).alias("b")))
    own = F.col("matches.item").cast("array<string>").alias("items")
    longest = F.array_max(F.col("matches.length")).alias("longest")
    first, *others = (
        found.select("doc_id", "digest", "n_words", spans.alias("spans"), own, longest)
        for found in _passes(docs, items, window, **options)
    )
    if others:
        # only what other blocks hit is grouped, by text and block before the blocks are put together,
        # so that a text has a row per block however many rows repeat it
        hits = [o.where(F.size("spans") > 0).withColumn("block", F.lit(i)) for i, o in enumerate(others)]
        parts = ("spans", "items", "longest")
        more = reduce(DataFrame.union, hits).groupBy("doc_id", "digest", "block").agg(*[F.first(c).alias(c) for c in parts])
        more = more.groupBy(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest")).agg(
            *[F.flatten(F.collect_list(c)).alias(f"more_{c}") for c in parts[:2]], F.max("longest").alias("more_longest")
        )
        same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_digest"))
        first = first.join(more, same, "left").select(
            "doc_id",
            "digest",
            "n_words",
            *[F.concat(c, F.coalesce(f"more_{c}", F.slice(c, 1, 0))).alias(c) for c in parts[:2]],
            F.greatest("longest", "more_longest").alias("longest"),
        )
    one = first.select(
        "doc_id",
        "digest",
        "n_words",
        F.array_sort("spans").alias("spans"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        F.coalesce("longest", F.lit(0)).alias("longest"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    covered = F.aggregate(
        "spans",
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["b"] - F.greatest(s["a"], acc["to"]))).alias("n"),
            F.greatest(acc["to"], s["b"]).alias("to"),
        ),
        lambda acc: acc["n"],
    )
    return one.select("doc_id", "digest", "n_words", covered.alias("n_hit"), "items", "longest").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, items, longest, contaminated``, one row per document.

    ``items`` are the ids of matched items, sorted as strings; ``longest`` is the longest match.
    """
    return _judged(docs, items, window, share, **options).drop("digest")


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, their columns as they are."""
    # the contaminated are few, so that Spark can send their ids and digests to the documents
    gone = _judged(docs, items, **options).where("contaminated")
    gone = gone.select(F.col("doc_id").alias("__gone_id"), F.col("digest").alias("__gone_digest")).distinct()
    same_id = F.col(options.get("id_column", "doc_id")).eqNullSafe(F.col("__gone_id"))
    same_text = text_digest(options.get("text_column", "text")) == F.col("__gone_digest")
    return docs.join(gone, same_id & same_text, "left_anti")
