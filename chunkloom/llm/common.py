"""What the operators share: words, Arrow batches, and the tables of a folder."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Words are what ASCII white space separates: in Python bytes.split(), in SQL this pattern.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

Columns = dict[str, Any]
Worker = Callable[[Iterator[pa.RecordBatch]], Iterable[Columns]]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_columns(frame: DataFrame, ddl: str, worker: Worker) -> DataFrame:
    """``frame`` through a worker that turns Arrow batches into dictionaries of columns."""
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in worker(batches):
            yield pa.RecordBatch.from_pydict(columns, schema=schema)

    return frame.mapInArrow(run, ddl)


def binary_text(column: str = "text") -> Column:
    """The UTF-8 bytes of a text, empty for null; also of text that is no valid UTF-8."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def text_digest(column: str = "text") -> Column:
    """128 bits that tell the texts of rows apart whose ids do not; the same for null and empty texts."""
    return F.unhex(F.md5(binary_text(column)))


def lists(rows: list[tuple], names: Iterable[str]) -> Columns:
    """Rows as columns."""
    names = list(names)
    return dict(zip(names, map(list, zip(*rows)), strict=True)) if rows else {n: [] for n in names}


def slices_of(values: pa.Array, bound: int) -> Iterator[tuple[int, int]]:
    """Start and length of runs of strings or binary values of about ``bound`` bytes; a longer one is alone."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        stop = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + bound, "right"))
        stop = max(start + 1, stop)
        yield start, stop - start
        start = stop


def kept_in_process(kind: str, key: object, make: Callable[[], Any], beside: tuple[str, ...] = ()) -> Any:
    """What a Python worker keeps from one task to the next: one value per kind, for the last key.

    Functions are shipped by value, so their modules' own variables do not outlive a task. Workers outlive
    the stages of a job, so a new value takes the place of those of all other kinds but ``beside``.
    """
    place = sys.modules.setdefault("_kept_between_tasks", types.ModuleType("_kept_between_tasks")).__dict__
    kept = place.setdefault("kept", {})
    if kind not in kept or kept[kind][0] != key:
        # the old values go before the new one is made
        for other in [k for k in kept if k not in beside]:
            del kept[other]
        pa.default_memory_pool().release_unused()
        kept[kind] = (key, make())
    return kept[kind][1]


class WordIds:
    """A 64-bit value for each word, remembered up to a bound."""

    def __init__(self, bound: int = 400_000):
        import xxhash

        self._hash = xxhash.xxh3_64_intdigest
        self._known: dict[bytes, int] = {}
        self._bound = bound

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > self._bound:
            known.clear()
        try:
            return np.fromiter((known[w] for w in words), np.uint64, len(words))
        except KeyError:
            for word in words:
                if word not in known:
                    known[word] = self._hash(word)
            return np.fromiter((known[w] for w in words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and shift)."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def window_hashes(ids: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all windows of ``width`` consecutive words."""
    if len(ids) < width:
        return np.empty(0, np.uint64)
    random = np.random.default_rng(1000 + seed)
    factors = random.integers(1, 2**63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    count = len(ids) - width + 1
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            total += ids[i : i + count] * factors[i]
    return mixed(total)
