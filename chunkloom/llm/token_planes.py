"""Token ids as shuffled planes: blocks of ids transposed into bit or byte planes, zstandard inside.

The file format. Documents are put in ascending order and cut into shards (one task, one shard); a
shard is a run of blocks of ``block_ids`` ids, its last one shorter. A block is one Parquet row of

* ``shard``, ``block``, ``n_ids``: its place and size;
* ``planes``: one zstandard frame per plane. Byte plane ``p`` holds byte ``p`` of every little-endian
  32-bit id. Bit plane ``p`` holds bit ``p`` of every id, eight ids to a byte, low bit first; planes
  above the highest bit in use are empty and left out;
* ``doc_ids``, ``doc_sizes``, ``first_doc``, ``starts_inside``, ``ends_inside``: the chunk index, which
  documents lie in the block with how many ids, the number in its shard of the first one, and
  whether the first began earlier and the last goes on.

Parquet is only the container: Spark writes it anywhere, commits it whole or not at all, and a lost
task is written again. A reader needs one block at a time.

Defined cases: a null text is empty, so it is the end id alone; a null id is smallest; documents that
share an id stand next to each other and each keeps its own row; no documents give no blocks. Of the
input only the id and the text are read. A text is tokenised whole, in the memory of one task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, kept_in_process, lists, map_columns

BLOCK_IDS = 1 << 16
END_ID = 1
LEVEL = 3
KNOWN_WORDS = 900_000
RUN_BYTES = 8 << 20
_MARKS = "!\"#$%&()*+,./:;<=>?@^_`{|}~-"  # ASCII punctuation, but for what contractions are made of
_MARK_BYTES = frozenset(_MARKS.encode())
_MARK_RUN = re.compile(f"[{_MARKS}]+".encode())


class WordEncoder:
    """The ids of texts from the ids of their words, which are remembered up to a bound.

    Right for lower-casing byte-level tokenizers with word ends, whose pre-tokenizer neither joins
    what white space separates nor lets letters run into the marks behind them; ``suits`` tells.
    Plain words (Latin letters, then marks) are merged by the same model without its normalizer and
    patterns, many at a time. Ids of all words lie in one array, and a word is a place in it.
    """

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        bare = {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self._bare = Tokenizer.from_str(json.dumps(json.loads(self._whole.to_str()) | bare))
        self._ends = np.zeros(self._bare.get_vocab_size(), bool)
        self._ends[[i for token, i in self._bare.get_vocab().items() if token.endswith("</w>")]] = True
        self._bound = known_words
        self._forget()

    @staticmethod
    def suits(path: str) -> bool:
        from tokenizers import Tokenizer

        parts = json.loads(Tokenizer.from_file(path).to_str())
        names = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        return "Lowercase" in names and parts["model"].get("end_of_word_suffix") == "</w>"

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {b"": 0}
        self._pool = np.empty(0, np.uint32)
        self._begins = np.zeros(1, np.int64)
        self._sizes = np.zeros(1, np.int64)

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for start, length in _runs_of(texts):
            words = pc.ascii_split_whitespace(texts.slice(start, length))
            flat = words.flatten().dictionary_encode()
            if len(self._known) + len(flat.dictionary) > self._bound:
                self._forget()
            numbers = self._numbers(flat.dictionary)
            codes = numbers[flat.indices.to_numpy()]
            counts = self._sizes[codes]
            after = np.zeros(len(codes) + 1, np.int64)
            np.cumsum(counts, out=after[1:])
            place = np.repeat(self._begins[codes] - after[:-1], counts)
            place += np.arange(after[-1])
            out = self._pool[place]
            edges = after[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])]
            for i in range(length):
                yield out[edges[i] : edges[i + 1]]

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word; unknown words are learned."""
        spelled = words.cast(pa.binary()).to_pylist()
        known = self._known
        numbers = np.fromiter((known.get(w, -1) for w in spelled), np.int64, len(spelled))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            unknown = words.take(pa.array(new))
            plain = pc.match_substring_regex(unknown, f"^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+[{_MARKS}]*$")
            plain = plain.to_numpy(zero_copy_only=False)
            numbers[new[plain]] = self._learn([spelled[i] for i in new[plain]], self._merge_plain)
            numbers[new[~plain]] = self._learn([spelled[i] for i in new[~plain]], self._merge_other)
        return numbers

    def _learn(self, words: list[bytes], merge) -> np.ndarray:
        first = len(self._begins)
        numbers = np.arange(first, first + len(words))
        parts, sizes = [], []
        for i in range(0, len(words), 4096):
            ids, size = merge(words[i : i + 4096])
            parts.append(ids)
            sizes.append(size)
        if words:
            sizes = np.concatenate(sizes)
            self._begins = np.concatenate([self._begins, len(self._pool) + np.cumsum(sizes) - sizes])
            self._sizes = np.concatenate([self._sizes, sizes])
            self._pool = np.concatenate([self._pool, *parts])
            self._known.update(zip(words, numbers.tolist(), strict=True))
        return numbers

    def _merge_plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        marked = np.fromiter((w[-1] in _MARK_BYTES for w in words), np.int64, len(words))
        joined = b" ".join(words).decode().lower().encode()
        apart = _MARK_RUN.sub(rb" \g<0>", joined).decode("latin-1").translate(_BYTE_LETTERS)
        ids = np.asarray(self._bare.encode_batch_fast([apart], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self._ends[ids]) + 1
        last = np.cumsum(1 + marked) - 1  # a word with marks has two ends
        if len(ends) != last[-1] + 1:
            raise ValueError("a word has no end among its ids")
        return ids, np.diff(ends[last], prepend=0)

    def _merge_other(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        encoded = self._whole.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        ids = [e.ids for e in encoded]
        return np.array([i for own in ids for i in own], np.uint32), np.array([len(own) for own in ids], np.int64)


class WholeEncoder:
    """Any other tokenizer: each text as a whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for text in texts.cast(pa.binary()):
            encoded = self._whole.encode(text.as_py().decode("utf-8", "replace"), add_special_tokens=False)
            yield np.asarray(encoded.ids, "<u4")


def encoder_for(path: str) -> WordEncoder | WholeEncoder:
    return WordEncoder(path) if WordEncoder.suits(path) else WholeEncoder(path)


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: printable bytes stand for
    themselves, the others follow from U+0100 in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters() | {0x20: " "}  # here a blank separates


def _runs_of(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``RUN_BYTES``; a longer text is alone."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy())
    start = 0
    while start < len(sizes):
        bound = (sizes[start - 1] if start else 0) + RUN_BYTES
        stop = max(start + 1, int(np.searchsorted(sizes, bound, "right")))
        yield start, stop - start
        start = stop


def to_planes(ids: np.ndarray, kind: str, compress) -> list[bytes]:
    if kind == "byte":
        planes = ids.view(np.uint8).reshape(-1, 4).T
        return [compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    used = int(ids.max()).bit_length() if len(ids) else 0
    return [compress(np.packbits((ids >> np.uint32(p)).astype(np.uint8) & 1, bitorder="little").tobytes()) for p in range(used)]


def from_planes(planes: list[bytes], n_ids: int, kind: str, decompress) -> np.ndarray:
    if kind == "byte":
        raw = [np.frombuffer(decompress(p), np.uint8) for p in planes]
        return np.ascontiguousarray(np.stack(raw, 1)).view("<u4").reshape(-1)
    ids = np.zeros(n_ids, np.uint32)
    for p, plane in enumerate(planes):
        bits = np.unpackbits(np.frombuffer(decompress(plane), np.uint8), count=n_ids, bitorder="little")
        ids |= bits.astype(np.uint32) << np.uint32(p)
    return ids


_INDEX = "doc_ids array<{id}>, doc_sizes array<bigint>, first_doc bigint, starts_inside boolean, ends_inside boolean"


def encode_blocks(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    kind: str = "bit",
    block_ids: int = BLOCK_IDS,
    end_id: int = END_ID,
) -> DataFrame:
    """Documents in ascending order as blocks of planes.

    The text is moved once, by ranges of the id; equal ids are told apart by a hash of the text, so
    that a common id does not land in one task.
    """
    picked = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    tied = F.xxhash64("text")
    ordered = picked.repartitionByRange("doc_id", tied).sortWithinPartitions("doc_id", tied)
    id_type = docs.schema[id_column].dataType.simpleString()
    ddl = f"shard int, block bigint, n_ids bigint, planes array<binary>, {_INDEX.format(id=id_type)}"
    names = [part.split()[0] for part in ddl.split(", ")]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        encode = kept_in_process("encoder", tokenizer, lambda: encoder_for(tokenizer))
        end = np.asarray([end_id], "<u4")
        shard = TaskContext.get().partitionId()
        block, number = 0, -1
        waiting, size, keys, sizes, first, inside = [], 0, [], [], 0, False

        def full(ends_inside: bool) -> tuple:
            ids = np.concatenate(waiting)
            return (shard, block, len(ids), to_planes(ids, kind, compress), keys, sizes, first, inside, ends_inside)

        for batch in batches:
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                ids = np.concatenate([ids, end])
                number += 1
                at, total = 0, len(ids)
                while at < total:
                    take = min(total - at, block_ids - size)
                    if not keys:
                        first, inside = number, at > 0
                    waiting.append(ids[at : at + take])
                    keys.append(key)
                    sizes.append(take)
                    size, at = size + take, at + take
                    if size == block_ids:
                        rows.append(full(at < total))
                        block, waiting, size, keys, sizes = block + 1, [], 0, [], []
            if rows:
                yield lists(rows, names)
        if keys:
            yield lists([full(False)], names)

    return map_columns(ordered, ddl, worker)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    encode_blocks(docs, tokenizer, **options).write.parquet(path)


def read_blocks(blocks: DataFrame, kind: str = "bit") -> DataFrame:
    """``shard, doc, doc_id, at, n_ids, ids_crc32, ids``: one row per document and block it lies in.

    ``at`` counts the ids before it in the block's shard. ``ids`` (little-endian 32 bits) is given for
    documents that cross a block's edge, the checksum for those that do not.
    """
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    place = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(place), F.lit(0)).alias("before"))
    ddl = f"shard int, doc bigint, doc_id {id_type}, block bigint, at bigint, n_ids bigint, ids_crc32 bigint, ids binary"
    names = [part.split()[0] for part in ddl.split(", ")]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                raw = memoryview(from_planes(row["planes"], row["n_ids"], kind, decompress).tobytes())
                rows, at, last = [], 0, len(row["doc_ids"]) - 1
                for i, (key, size) in enumerate(zip(row["doc_ids"], row["doc_sizes"], strict=True)):
                    piece = raw[4 * at : 4 * (at + size)]
                    partial = (i == 0 and row["starts_inside"]) or (i == last and row["ends_inside"])
                    crc, ids = (None, bytes(piece)) if partial else (crc32(piece), None)
                    rows.append((row["shard"], row["first_doc"] + i, key, row["block"], at, size, crc, ids))
                    at += size
                yield lists(rows, names)

    pieces = map_columns(blocks, ddl, worker)
    # a row per block: far smaller than the blocks, but not bounded, so Spark chooses the join
    placed = pieces.join(before, ["shard", "block"])
    return placed.withColumn("at", F.col("at") + F.col("before")).drop("before", "block")


def document_digests(blocks: DataFrame, kind: str = "bit") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the blocks alone."""
    pieces = read_blocks(blocks, kind)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    # one row per writing task
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("offset"))
    whole = pieces.where("ids IS NULL").select("shard", "doc_id", "at", F.col("n_ids").alias("n_tokens"), "ids_crc32")
    parts = pieces.where("ids IS NOT NULL").groupBy("shard", "doc", "doc_id").agg(
        F.min("at").alias("at"),
        F.sum("n_ids").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"),
    )
    joined = F.concat_ws("", F.transform("parts", lambda p: F.hex(p["ids"])))
    parts = parts.withColumn("ids_crc32", F.crc32(F.unhex(joined)))
    every = whole.unionByName(parts.select("shard", "doc_id", "at", "n_tokens", "ids_crc32"))
    return every.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def decode_documents(blocks: DataFrame, kind: str = "bit") -> DataFrame:
    """``doc_id, start, ids``: the ids of every document, in memory one document at a time."""
    pieces = read_blocks_whole(blocks, kind)
    return pieces.groupBy("shard", "doc", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts")
    ).select("shard", "doc", "doc_id", F.flatten(F.col("parts.ids")).alias("ids"))


def read_blocks_whole(blocks: DataFrame, kind: str = "bit") -> DataFrame:
    """``shard, doc, doc_id, at, ids``: the ids of each document in each block, as arrays."""
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    ddl = f"shard int, doc bigint, doc_id {id_type}, at bigint, ids array<bigint>"
    names = [part.split()[0] for part in ddl.split(", ")]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"], kind, decompress)
                rows, at = [], 0
                for i, (key, size) in enumerate(zip(row["doc_ids"], row["doc_sizes"], strict=True)):
                    rows.append((row["shard"], row["first_doc"] + i, key, row["block"], ids[at : at + size].tolist()))
                    at += size
                yield lists(rows, names)

    return map_columns(blocks, ddl, worker)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
