"""Repeated passages removed by difference-cover anchors.

A window is ``window`` consecutive words of one document. Every word is removed that lies in a window
whose words also start earlier: in a document of smaller id, or earlier in the same one.

1. Documents whose words are all the same as those of a document of smaller id are removed whole, if
   they have a window, and need no further look.
2. Anchors. With a difference cover D of the period v, any two places have a shift below v that brings
   both to places whose remainder is in D. So windows that match share an anchor: the first
   ``window - v + 1`` words at such places. Only these places are hashed and shuffled, and an anchor is
   of interest if it occurs twice. With v = 13 and 4 places in 13 this is 4/13 of a hash per word.
3. Extension. Only windows that hold such an anchor within their first v words can match. They are
   hashed whole (96 bits), and all but the first of each are repeats.

Hot passages: before either shuffle each slice of ``SLICE_WORDS`` words settles what repeats inside it,
so that a passage has at most one row per slice in the shuffle, not one per document. The texts are
shuffled once, compressed and by id, and that exchange serves all three steps.

Defined cases: a null text has no words; texts shorter than a window are left as they are; a row with a
null id has no place in the order, so nothing is removed from it or because of it; rows that repeat an
id and a text get the same result; rows that repeat an id with other texts are told apart by a hash of
the text, which also orders them; extra columns do not matter. Memory: the words of one text, the
hashes of one slice, and the values of up to 200,000 words kept between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, WordIds, binary_text, kept_in_process, map_columns, mixed, window_hashes

WINDOW = 20
# Perfect difference sets, fixed values: every difference modulo the period occurs once.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
PERIOD = 13
SLICE_WORDS = 400_000


def anchor_places(count: int, period: int) -> np.ndarray:
    """Places below ``count`` whose remainder is in the cover."""
    rows = np.arange(0, count, period)[:, None] + np.array(COVERS[period])
    rows = rows.reshape(-1)
    return rows[rows < count]


def covered_words(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Which words the windows that begin at ``starts`` cover."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:-1]) > 0


def windows_with(anchors: np.ndarray, n_windows: int, period: int) -> np.ndarray:
    """Starts of windows that hold an anchor within their first ``period`` words."""
    change = np.zeros(n_windows + period + 1, np.int64)
    np.add.at(change, np.maximum(anchors - period + 1, 0), 1)
    np.add.at(change, np.minimum(anchors, n_windows - 1) + 1, -1)
    return np.flatnonzero(np.cumsum(change[:n_windows]) > 0)


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id, tie, text`` with the texts as zstandard frames, for their way through the shuffle."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [compress(t.as_buffer()) for t in batch.column(2)]
            yield {"doc_id": batch.column(0), "tie": batch.column(1), "text": texts}

    return map_columns(docs.select("doc_id", "tie", "text"), f"doc_id {id_type}, tie bigint, text binary", worker)


def _unpacked(texts: pa.Array) -> Iterator[bytes]:
    import zstandard

    decompress = zstandard.ZstdDecompressor().decompress
    return (decompress(t.as_buffer()) for t in texts)


def _digests(docs: DataFrame) -> DataFrame:
    """``doc_id, tie, n_words, digest`` of the words of every document."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            sizes, digests = [], []
            for text in batch.column(2):
                words = text.as_py().split()
                sizes.append(len(words))
                digests.append(blake2b(b" ".join(words), digest_size=16).digest())
            yield {"doc_id": batch.column(0), "tie": batch.column(1), "n_words": sizes, "digest": digests}

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_columns(docs.select("doc_id", "tie", "text"), f"doc_id {id_type}, tie bigint, n_words bigint, digest binary", worker)


def _special(docs: DataFrame, window: int) -> DataFrame:
    """``special_id, special_tie, copy, shared``: texts that an earlier document has whole, and ids
    that several texts share. All other documents are not listed."""
    about = _digests(docs)
    first = about.groupBy("digest").agg(F.min(F.struct("doc_id", "tie")).alias("first"), F.count("*").alias("n"))
    place = F.struct("doc_id", "tie")
    copies = about.where(F.col("n_words") >= window).join(first.where("n > 1"), "digest").where(place > F.col("first"))
    copies = copies.select("doc_id", "tie", F.lit(True).alias("copy"), F.lit(False).alias("shared"))
    # xxhash64 tells texts of one id apart; both of a pair that it does not would be taken for one
    ids = docs.groupBy("doc_id").agg(F.min("tie").alias("x"), F.max("tie").alias("y")).where("x < y").select("doc_id")
    shared = docs.select("doc_id", "tie").join(ids, "doc_id", "left_semi")
    shared = shared.select("doc_id", "tie", F.lit(False).alias("copy"), F.lit(True).alias("shared"))
    one = copies.union(shared).groupBy("doc_id", "tie").agg(F.bool_or("copy").alias("copy"), F.bool_or("shared").alias("shared"))
    return one.select(F.col("doc_id").alias("special_id"), F.col("tie").alias("special_tie"), "copy", "shared")


def _base() -> Column:
    """Added to places of documents that share their id; a multiple of 2 ** 36."""
    return F.when(F.col("shared"), F.shiftleft(F.expr("pmod(tie, 16777213)") + 1, 36)).otherwise(F.lit(0)).cast("bigint")


def _settle(keys: list[np.ndarray], docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a key that an earlier row of the slice has, and which are not alone with it."""
    if not len(places):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.lexsort((places, docs, *reversed(keys)))
    same = np.ones(max(0, len(order) - 1), bool)
    for key in keys:
        ranked = key[order]
        same &= ranked[1:] == ranked[:-1]
    first = np.maximum.accumulate(np.concatenate([[0], np.where(same, 0, np.arange(1, len(order)))]))
    # rows that repeat the first one, id and text, are the same document
    other = (docs[order] != docs[order][first]) | (places[order] != places[order][first])
    again, many = np.zeros(len(order), bool), np.zeros(len(order), bool)
    again[order] = other
    many[order[1:]] |= same
    many[order[:-1]] |= same
    return again, many


def _joined(parts: list[tuple]) -> list[np.ndarray]:
    """The arrays of several texts, each in a row; first the number of the text."""
    rows = np.concatenate([np.full(len(p[1]), p[0]) for p in parts])
    return [rows, *(np.concatenate(column) for column in list(zip(*parts, strict=True))[1:])]


def _marked(places: np.ndarray, again: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Place and both flags in one number; rows stay in the order of the texts, which packs well."""
    return places << 2 | many.astype(np.int64) << 1 | again


def _anchors(docs: DataFrame, window: int, period: int) -> DataFrame:
    """``key, doc_id, mark``: the anchors of documents.

    Of several in a slice one carries the key, for the other slices to see. The rest get a key of
    their own, so that they do not meet in one task.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def settled(docs: pa.Array, parts: list[tuple]) -> Columns:
        row, key, place = _joined(parts)
        again, many = _settle([key], row, place)
        return {
            "key": np.where(again, mixed(place.astype(np.uint64) + key), key).view(np.int64),
            "doc_id": docs.take(pa.array(row)),
            "mark": _marked(place, again, many),
        }

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        ids = kept_in_process("word-ids", None, lambda: WordIds(200_000))
        for batch in batches:
            parts, held = [], 0
            for row, (base, text) in enumerate(zip(batch.column(1).to_pylist(), _unpacked(batch.column(2)), strict=True)):
                words = text.split()
                if len(words) < window:
                    continue
                values = window_hashes(ids(words), window - period + 1, 1)
                at = anchor_places(len(values), period)
                parts.append((row, values[at], at + base))
                held += len(words)
                if held >= SLICE_WORDS:
                    yield settled(batch.column(0), parts)
                    parts, held = [], 0
            if parts:
                yield settled(batch.column(0), parts)

    return map_columns(docs.select("doc_id", "base", "text"), f"key bigint, doc_id {id_type}, mark bigint", worker)


def _windows(docs: DataFrame, window: int, period: int) -> DataFrame:
    """``key, key2, doc_id, mark``: windows that can repeat."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def settled(docs: pa.Array, ranks: np.ndarray, parts: list[tuple]) -> Columns:
        row, a, b, place = _joined(parts)
        b = (b >> np.uint64(32)).astype(np.int64).astype(np.int32)
        again, many = _settle([a, b], ranks[row], place)
        return {
            "key": np.where(again, mixed(a + place.astype(np.uint64)), a).view(np.int64),
            "key2": b,
            "doc_id": docs.take(pa.array(row)),
            "mark": _marked(place, again, many),
        }

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        ids = kept_in_process("word-ids", None, lambda: WordIds(200_000))
        for batch in batches:
            parts, held = [], 0
            docs = batch.column(0)
            known = docs.to_pylist()
            rank = {k: i for i, k in enumerate(sorted(set(known)))}
            ranks = np.array([rank[k] for k in known])
            given = (batch.column(1).to_pylist(), batch.column(2), _unpacked(batch.column(3)))
            for row, (base, anchors, text) in enumerate(zip(*given, strict=True)):
                words = text.split()
                values = ids(words)
                starts = windows_with(_own(anchors.values, base), max(0, len(words) - window + 1), period)
                parts.append((row, window_hashes(values, window, 2)[starts], window_hashes(values, window, 3)[starts], starts + base))
                held += len(words)
                if held >= SLICE_WORDS:
                    yield settled(docs, ranks, parts)
                    parts, held = [], 0
            if parts:
                yield settled(docs, ranks, parts)

    return map_columns(
        docs.select("doc_id", "base", "anchors", "text"), f"key bigint, key2 int, doc_id {id_type}, mark bigint", worker
    )


def _by_document(rows: DataFrame, name: str) -> DataFrame:
    """The places under each id as one array: of one text, or of all that share the id."""
    grouped = rows.select(F.col("doc_id").alias("of"), F.shiftright("mark", 2).alias("place")).groupBy("of")
    return grouped.agg(F.collect_list("place").alias(name))


def _own(places: pa.Array, base: int) -> np.ndarray:
    """The places that belong to the text with this base, counted in it."""
    found = places.to_numpy() - base
    return found[(found >= 0) & (found < 1 << 36)]


def _again() -> Column:
    return F.col("mark").bitwiseAND(1) == 1


def _apart() -> Column:
    """Null for rows that share their key; a row that an earlier one of its slice stands for has its own."""
    return F.when(_again(), F.col("mark"))


def _strip(rows: DataFrame, window: int, with_text: bool) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, if asked for, the kept words as a text."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string"
    if with_text:
        ddl += ", kept_text binary"

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {"doc_id": batch.column(0), "n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            given = (batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), _unpacked(batch.column(4)))
            for copy, base, starts, text in zip(*given, strict=True):
                words = text.split()
                kept = [] if copy else words
                if starts.is_valid and not copy:
                    gone = covered_words(_own(starts.values, base), len(words), window)
                    kept = [words[i] for i in np.flatnonzero(~gone)]
                joined = b" ".join(kept)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(sha256(joined).hexdigest())
                if with_text:
                    out["kept_text"].append(joined)
            yield out if with_text else {k: v for k, v in out.items() if k != "kept_text"}

    return map_columns(rows.select("doc_id", "copy", "base", "starts", "text"), ddl, worker)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    period: int = PERIOD,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text``): one row per document."""
    if period > window or period not in COVERS:
        raise ValueError(f"the period must be one of {sorted(COVERS)} and at most the window")
    picked = docs.select(F.col(id_column).alias("doc_id"), binary_text(text_column).alias("text"))
    placed = picked.where("doc_id IS NOT NULL").withColumn("tie", F.xxhash64("text"))
    # one exchange of the texts serves the three joins below
    # the filter is one that Spark adds before an inner join; stated here it is in every use alike
    texts = _packed(placed).where("doc_id IS NOT NULL").repartition("doc_id")
    special = _special(placed, window)
    # only the id is a join key, so that the exchange above serves; the rest is compared behind it, by
    # an expression that is no join key and, unlike a difference of hashes, cannot overflow
    is_special = (F.col("doc_id") == F.col("special_id")) & (F.col("tie").bitwiseXOR(F.col("special_tie")) == 0)
    judged = texts.join(special, is_special, "left").withColumn("copy", F.coalesce("copy", F.lit(False)))
    judged = judged.select("doc_id", "tie", "copy", _base().alias("base"), "text")
    mine = F.col("doc_id") == F.col("of")

    anchors = _anchors(judged.where("NOT copy"), window, period)
    alike = F.count("*").over(Window.partitionBy("key", _apart()))
    twice = anchors.withColumn("n", alike).where((F.col("n") > 1) | (F.col("mark").bitwiseAND(2) == 2))
    near = judged.where("NOT copy").join(_by_document(twice, "anchors"), mine).select("doc_id", "base", "anchors", "text")

    found = _windows(near, window, period)
    order = Window.partitionBy("key", "key2", _apart()).orderBy("doc_id", F.shiftright("mark", 2))
    repeats = found.withColumn("n", F.rank().over(order)).where((F.col("n") > 1) | _again())
    stripped = _strip(judged.join(_by_document(repeats, "starts"), mine, "left"), window, with_text)
    unplaced = _packed(picked.where("doc_id IS NULL").withColumn("tie", F.lit(0).cast("bigint"))).select(
        "doc_id",
        F.lit(False).alias("copy"),
        F.lit(0).cast("bigint").alias("base"),
        F.lit(None).cast("array<bigint>").alias("starts"),
        "text",
    )
    return stripped.union(_strip(unplaced, window, with_text))
