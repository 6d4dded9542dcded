"""Exact nearest-neighbour scan of a batch of requests over a table of chunks.

The chunks are read once. Each Arrow batch of chunks is scored against a block of requests with a
matrix product and only the hits that can still be among a request's nearest leave the task, so
pairs are never emitted. A request without ``top`` gets all its hits within ``horizon``.

The product only screens: a bound on its rounding error is added to the cut-off, and what passes
is scored again pair by pair. Distances, and so ties, do not depend on how Spark cuts the batches.

A small batch of requests goes to the tasks as one broadcast. A larger one is cut into groups that
fit in a task, and chunks are dealt to slots. Each (slot, group) is one partition: its requests come
first and stay, its chunks follow and are read once, and only the nearest hits of each request leave.
Requests and chunks are written once each, whatever the number of tiles, and every tile reads its group and
its slot from there. Chunks are read once per group, requests once per slot, which also sends its hits: there
are as many of each as make what is moved least, and a few tiles for each core however large the input is.

Unbounded lists of many requests are ranked where they are scored: with one slot, all hits of a request
come up in one task (``scan_listed``), and leave it in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.operators.requests import SMALL_REQUESTS, BatchProfile

POOL_ROWS = 1 << 19  # hits kept per task
LISTED_ROWS = 1 << 23  # hits of unbounded lists held per task, 16 bytes each, on average
LISTED_LONGEST = 1 << 22  # hits of one such list
EMITTED_ROWS = 50_000
HIT_BYTES = 100  # of one hit in a shuffle, with the id of its request
TILES_PER_CORE = 2
BLOCK_REQUESTS = 512
BLOCK_CHUNKS = 8192
# Smaller blocks are dealt, so that all partitions get about as many.
DEALT_REQUESTS = 64
DEALT_CHUNKS = 256
_CELLS = 1 << 21  # scores held at once by the kernel
_WIDE_CELLS = 1 << 22  # of manhattan, which works along long rows
_PAIR_CELLS = 1 << 22  # vector elements held at once when pairs are scored again
_CACHED_CELLS = 1 << 18  # of these, as many as stay in the processor's cache
_TILE = 1 << 15
_TILE_WIDTH = 1 << 11
_COARSE_TILE = 1 << 17  # of one byte each
_FIRST_CHUNKS = 1 << 11  # scored by the finer screen alone where no bound is known
_LEVELS = 63  # four differences of them fit in a byte
_USEFUL = 1 / 8  # share of pairs up to which scoring them all again is cheaper than a finer screen
_IN_PARTITION = (1 << 33) - 1  # of a monotonically increasing id

HIT_DDL = (
    "request_id string, tenant string, chunk_id string, parent_id string, "
    "top int, auto_limit int, distance double"
)


def matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers that have a vector, and those vectors as one float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    present = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
    kept = vectors.drop_null()
    if len(kept) == 0:
        return present, np.empty((0, 0))
    sizes = pc.list_value_length(kept).to_numpy(zero_copy_only=False)
    if (sizes != sizes[0]).any():
        raise ValueError(f"vectors of different size: {sizes.min()} and {sizes.max()}")
    values = kept.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return present, values.reshape(len(kept), sizes[0])


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", m, m))


def pair_distance(a: np.ndarray, b: np.ndarray, method: str) -> np.ndarray:
    """Distance of row i of ``a`` to row i of ``b``; NaN for cosine with a zero vector."""
    if method in ("cosine", "dot"):
        inner = np.einsum("ij,ij->i", a, b)
        if method == "dot":
            return -inner
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.clip(1 - inner / (_norms(a) * _norms(b)), 0, 2)
    gap = a - b
    if method == "l2-squared":
        return np.einsum("ij,ij->i", gap, gap)
    return np.abs(gap).sum(axis=1) if method == "manhattan" else (gap != 0).sum(axis=1) * 1.0


def pair_distances(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray, method: str) -> np.ndarray:
    """``pair_distance`` of the rows ``i`` of ``q`` to the rows ``j`` of ``c``."""
    step = max(1, _CACHED_CELLS // max(1, c.shape[1]))
    pieces = (slice(at, at + step) for at in range(0, max(1, len(i)), step))
    return np.concatenate([pair_distance(q[i[piece]], c[j[piece]], method) for piece in pieces])


def _sums_by_dimension(q: np.ndarray, c: np.ndarray, step: Callable[..., None]) -> np.ndarray:
    """``step(q, c, out)`` summed over dimensions, in the type of ``q`` and in tiles of whole rows small
    enough for the processor's cache."""
    c = np.ascontiguousarray(c.T)
    total = np.zeros((len(q), c.shape[1]), q.dtype)
    width = max(1, min(c.shape[1], _TILE_WIDTH))
    height = max(1, _TILE // width)
    gap = np.empty(height * width, q.dtype)
    for left in range(0, c.shape[1], width):
        columns = np.ascontiguousarray(c[:, left : left + width])
        for start in range(0, len(q), height):
            sums, rows = total[start : start + height, left : left + width], q[start : start + height]
            part = gap[: sums.size].reshape(sums.shape)
            for j in range(len(columns)):
                step(rows[:, j, None], columns[j], part)
                np.add(sums, part, out=sums)
    return total


def _gap(q: np.ndarray, c: np.ndarray, out: np.ndarray) -> None:
    np.subtract(q, c, out=out)
    np.abs(out, out=out)


def _screen_manhattan(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums in steps of 16 bits where the values lie close enough together, else in single precision."""
    low, high = min(q.min(), c.min()), max(q.max(), c.max())
    levels = 65_000 // q.shape[1]
    step = (high - low) / levels if levels else np.inf
    if 0 < step < np.inf and step * 32 <= np.abs(c - c.mean()).mean():
        a, b = (np.rint((m - low) / step).astype(np.uint16) for m in (q, c))
        # the gap of two numbers is twice the larger less both; all sums stay below 2 ** 16
        larger = _sums_by_dimension(a, b, lambda x, y, out: np.maximum(x, y, out=out))
        both = a.sum(axis=1, dtype=np.int32)[:, None] + b.sum(axis=1, dtype=np.int32)
        # each value is off by half a step at most, each difference by one
        return (2 * larger.astype(np.int32) - both) * step, np.full(len(q), step * (q.shape[1] + 1))
    total = _sums_by_dimension(q.astype(np.float32), c.astype(np.float32), _gap)
    unit = (q.shape[1] + 16) * np.finfo(np.float32).eps
    return total, unit * total.max(axis=1, initial=0.0).astype(np.float64)


class CoarseGaps:
    """Chunks as numbers of six bits or fewer, which tell fast which manhattan distances can be up to a cut.

    A distance of the numbers differs from that of the vectors by what rounding took from both at most, which is
    measured for each of them.
    """

    def __init__(self, c: np.ndarray):
        self.levels = min(_LEVELS, 60_000 // max(1, c.shape[1]))
        self.low, self.step = self._scale(c)
        codes, lost = self.coded(c)
        self.codes = np.ascontiguousarray(codes.T)
        # a chunk that lost more than can be counted, or holds what is no number, is always open
        counted = lost <= 5_000 * self.step
        self.open = np.flatnonzero(~counted)
        self.lost = np.zeros(len(c))
        if self.suits():
            self.lost[counted] = np.ceil(lost[counted] / self.step)

    def _scale(self, c: np.ndarray) -> tuple[float, float]:
        """The range of values that loses least on some of the chunks; values outside lose what they lie outside by."""
        some = c[:: max(1, len(c) // 64)]
        middle, spread = some.mean(), some.std()
        ranges = [(some.min(), some.max()), *((middle - k * spread, middle + k * spread) for k in (2.5, 3.0, 4.0, 6.0))]
        best, least = (0.0, 0.0), np.inf
        for low, high in ranges:
            step = (high - low) / max(1, self.levels)
            if 0 < step < np.inf:
                lost = np.abs(some - (low + step * np.clip(np.rint((some - low) / step), 0, self.levels))).sum()
                best, least = ((low, step), lost) if lost < least else (best, least)
        return best

    def suits(self) -> bool:
        return self.levels >= 2 and self.step > 0

    def coded(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of each row, and how far they are from it in all."""
        if not self.suits():
            return np.zeros(m.shape, np.int8), np.zeros(len(m))
        codes = np.clip(np.rint((m - self.low) / self.step), 0, self.levels)
        lost = np.abs(m - (self.low + self.step * codes)).sum(axis=1)
        return np.nan_to_num(codes).astype(np.int8), lost

    def near(self, q: np.ndarray, start: int, stop: int, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Rows of ``q`` and of the chunks from ``start`` to ``stop`` (from 0) that may be up to the ``cut`` of the row
        apart; None where these are too many to be of use."""
        codes, lost = self.codes[:, start:stop], self.lost[start:stop]
        width, together = codes.shape[1], 255 // self.levels
        asked, lost_q = self.coded(q)
        # one more for what is lost in adding up; above all sums everything is open
        most = np.nan_to_num(np.floor((cut + lost_q) / self.step) + 1 + lost.max(), nan=65_535.0)
        most = np.clip(most, 0, 65_535).astype(np.uint16)[:, None]
        from_start = (lost.max() - lost).astype(np.uint16)
        height = max(1, _COARSE_TILE // width)
        sums = np.empty((height, width), np.uint16)
        gaps, gap = np.empty((2, height, width), np.int8)
        found_i, found_j, found = [], [], 0
        for top in range(0, len(asked), height):
            rows = asked[top : top + height]
            total, some, one = sums[: len(rows)], gaps[: len(rows)], gap[: len(rows)]
            some_sum, one_more = some.view(np.uint8), one.view(np.uint8)
            total[:] = from_start
            for first in range(0, len(codes), together):
                np.subtract(rows[:, first, None], codes[first], out=some)
                np.abs(some, out=some)
                for j in range(first + 1, min(first + together, len(codes))):
                    np.subtract(rows[:, j, None], codes[j], out=one)
                    np.abs(one, out=one)
                    np.add(some_sum, one_more, out=some_sum)
                np.add(total, some_sum, out=total)
            i, j = np.divmod(np.flatnonzero(total <= most[top : top + height]), width)
            found_i.append(i + top)
            found_j.append(j)
            found += len(i)
            if found > _USEFUL * len(rows) * width + _USEFUL * top * width:
                return None
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        wide = self.open[(self.open >= start) & (self.open < stop)] - start
        if len(wide):
            closed = ~np.isin(j, wide)
            i = np.concatenate([i[closed], np.repeat(np.arange(len(q)), len(wide))])
            j = np.concatenate([j[closed], np.tile(wide, len(q))])
        return i, j


def _screen_hamming(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact counts: by a matrix product where the chunks hold few values, each of which has columns of its own."""
    values = np.unique(c[:4])
    if len(values) <= 4 and sum(np.count_nonzero(c == v) for v in values) == c.size:
        ones = [np.concatenate([m == v for v in values], axis=1).astype(np.float32) for m in (q, c)]
        return c.shape[1] - ones[0] @ ones[1].T, np.zeros(len(q))
    unequal = lambda x, y, out: np.not_equal(x, y, out=out)
    return _sums_by_dimension(q.astype(np.float32), c.astype(np.float32), unequal), np.zeros(len(q))


def screen(q: np.ndarray, c: np.ndarray, method: str) -> tuple[np.ndarray, np.ndarray]:
    """Approximate distances of all rows of ``q`` to all of ``c``, and a per-row error bound."""
    if method in ("manhattan", "hamming"):
        return (_screen_manhattan if method == "manhattan" else _screen_hamming)(q, c)
    unit = (q.shape[1] + 16) * np.finfo(np.float64).eps
    nq, nc = _norms(q), _norms(c)
    if method == "cosine":
        with np.errstate(invalid="ignore", divide="ignore"):
            value = 1 - (q / nq[:, None]) @ (c / nc[:, None]).T
        return value, np.full(len(q), 4 * unit)
    inner = q @ c.T
    largest = nc.max(initial=0.0)
    if method == "dot":
        return -inner, unit * nq * largest
    value = nq[:, None] ** 2 + nc[None, :] ** 2 - 2 * inner
    return value, 4 * unit * (nq**2 + largest**2)


def quick_screen(q: np.ndarray, c: np.ndarray, method: str) -> tuple[np.ndarray, np.ndarray]:
    """``screen`` for distances that are scored again: cosine in single precision, on vectors of length one."""
    if method != "cosine":
        return screen(q, c, method)
    with np.errstate(invalid="ignore", divide="ignore"):
        a, b = ((m / _norms(m)[:, None]).astype(np.float32) for m in (q, c))
    value = a @ b.T
    np.subtract(1, value, out=value)
    return value, np.full(len(q), 4 * (q.shape[1] + 16) * float(np.finfo(np.float32).eps))


def within(rough: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the approximate distances up to the ``cut`` of their row."""
    if rough.dtype == np.float32:
        cut = np.nextafter(cut.astype(np.float32), np.float32(np.inf))
    return np.divmod(np.flatnonzero(rough <= cut[:, None]), rough.shape[1])


class RequestBlock:
    """Requests of one block, grouped by what they search with: vector, method and filter."""

    def __init__(self, table: pa.Table):
        self.table = table
        tops = table["top"].to_pylist()
        self.limited = np.array([t is not None for t in tops], dtype=bool)
        self.top = np.array([0 if t is None else max(t, 0) for t in tops], dtype=np.int64)
        horizons = table["horizon"].to_pylist()
        self.horizon = np.array([np.inf if h is None else h for h in horizons], dtype=np.float64)
        # distance of the last hit that counts, once a request has as many as it asked for
        self.worst = np.full(len(tops), np.inf)
        # for how many blocks of chunks the coarse screen is left out, each time it has left too many pairs open
        self.left_out = self.leave_out = 0
        queries = table["query_embedding"].combine_chunks()
        sizes = pc.list_value_length(queries).to_pylist()
        what = [table[c].to_pylist() for c in ("slot", "method", "spec")]
        members: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(*what, sizes)):
            members.setdefault(key, []).append(i)
        self.groups, self.without_vector = [], []
        for (slot, method, spec, size), found in members.items():
            for start in range(0, len(found), BLOCK_REQUESTS):
                rows = np.array(found[start : start + BLOCK_REQUESTS])
                if size is None:
                    self.without_vector.append((slot, method, spec, rows, None))
                else:
                    _, vectors = matrix(queries.take(pa.array(rows)))
                    self.groups.append((slot, method, spec, rows, vectors))

    def coarsely(
        self, gaps: CoarseGaps, queries: np.ndarray, start: int, stop: int, cut: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """What the coarse screen leaves open; tried again after a while where that was too much."""
        if not gaps.suits():
            return None
        if self.left_out < self.leave_out:
            self.left_out += 1
            return None
        found = gaps.near(queries, start, stop, cut)
        self.left_out, self.leave_out = 0, min(2 * self.leave_out + 1, 255) if found is None else 0
        return found

    def all_groups(self) -> list[tuple]:
        """Also the requests without a query vector, which only text can answer."""
        return self.groups + self.without_vector

    def emit(self, r: np.ndarray, distance: np.ndarray, chunks: pa.Table) -> pa.Table:
        asked = self.table.select(["request_id", "top", "auto_limit"]).take(pa.array(r))
        columns = {
            "request_id": asked["request_id"],
            "tenant": chunks["tenant"],
            "chunk_id": chunks["chunk_id"],
            "parent_id": chunks["parent_id"],
            "top": asked["top"],
            "auto_limit": asked["auto_limit"],
            "distance": pa.array(distance),
        }
        return pa.table(columns)


def with_spec(chunks: pa.Table, spec: int) -> np.ndarray:
    """Mask of the chunks that pass filter number ``spec``."""
    if "specs" not in chunks.column_names:
        return np.ones(len(chunks), dtype=bool)
    specs = chunks["specs"].combine_chunks()
    hit = specs.flatten().to_numpy(zero_copy_only=False) == spec
    owner = pc.list_parent_indices(specs).to_numpy(zero_copy_only=False)
    mask = np.zeros(len(chunks), dtype=bool)
    mask[owner[hit]] = True
    return mask


def in_order(rows: pa.Table, *keys: str) -> pa.Table:
    """Rows sorted as Spark sorts them, with nulls first."""
    return rows.take(pc.sort_indices(rows, sort_keys=[(k, "ascending") for k in keys], null_placement="at_start"))


def in_id_order(chunks: pa.Table) -> pa.Table:
    return in_order(chunks, "chunk_id", "tenant")


def nearest_first(
    block: RequestBlock, r: np.ndarray, distance: np.ndarray, place: np.ndarray
) -> np.ndarray:
    """Positions of the first ``top`` pairs of each request by distance and place.

    Places follow the order of ids, so of many equally near chunks (copies) only those that can
    rank are kept, before any text is touched.
    """
    order = np.lexsort((place, distance, r))
    sorted_r = r[order]
    nth = np.arange(len(r)) - np.searchsorted(sorted_r, sorted_r, side="left")
    return order[~block.limited[sorted_r] | (nth < block.top[sorted_r])]


def score(block: RequestBlock, chunks: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Table]]:
    """Hits of one batch of chunks: request rows, distances and the chunks' own columns."""
    chunks = in_id_order(chunks)
    carried = chunks.select(["tenant", "chunk_id", "parent_id"])
    for r, distance, place in hits(block, chunks):
        near = nearest_first(block, r, distance, place)
        yield r[near], distance[near], carried.take(pa.array(place[near]))


def hits(block: RequestBlock, chunks: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Request rows, distances and chunk rows of the pairs of one batch that may be hits."""
    vectors = {
        slot: matrix(chunks[f"v{slot}"].combine_chunks()) for slot in {g[0] for g in block.groups}
    }
    coarse: dict[tuple, CoarseGaps] = {}
    for slot, method, spec, rows, queries in block.groups:
        present, stored = vectors[slot]
        chosen = with_spec(chunks, spec)[present]
        present, stored = present[chosen], stored[chosen]
        if len(present) == 0:
            continue
        if queries.shape[1] != stored.shape[1]:
            raise ValueError(
                f"vectors of different size: {queries.shape[1]} and {stored.shape[1]}"
            )
        limit = int(block.top[rows].max()) if block.limited[rows].all() else None
        step = max(1, (_WIDE_CELLS if method == "manhattan" else _CELLS) // len(rows))
        # what the first of these chunks tell of the last hit that counts
        bound, start = np.full(len(rows), np.inf), 0
        while start < len(present):
            far = np.fmin(np.minimum(block.worst[rows], block.horizon[rows]), bound)
            told = bool(np.isfinite(far).all())
            width = step if told or limit is None or method != "manhattan" else max(_FIRST_CHUNKS, 4 * limit)
            part = stored[start : start + min(step, width)]
            open_pairs = None
            if told and method == "manhattan":
                if (slot, spec) not in coarse:
                    coarse[slot, spec] = CoarseGaps(stored)
                open_pairs = block.coarsely(coarse[slot, spec], queries, start, start + len(part), far)
            if open_pairs is None:
                rough, error = quick_screen(queries, part, method)
                # once all requests have their hits, the last of these bounds better than one batch
                if limit is not None and 0 < limit < len(part) and not told:
                    bound = np.fmin(bound, np.partition(rough, limit - 1, axis=1)[:, limit - 1] + error)
                    far = np.fmin(far, bound)
                open_pairs = within(rough, far + error)
            i, j = open_pairs
            pairs = max(1, _PAIR_CELLS // max(1, part.shape[1]))
            for at in range(0, len(i), pairs):
                qi, cj = i[at : at + pairs], j[at : at + pairs]
                distance = pair_distances(queries, part, qi, cj, method)
                near = np.flatnonzero(distance <= far[qi])
                yield rows[qi[near]], distance[near], present[start + cj[near]]
            start += len(part)


def measures(block: RequestBlock, chunks: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Request rows with the number, least and largest distance of their hits in one batch.

    Pairs are only scored again where the product's error leaves open whether they are hits, or the
    nearest or farthest ones.
    """
    vectors = {
        slot: matrix(chunks[f"v{slot}"].combine_chunks()) for slot in {g[0] for g in block.groups}
    }
    for slot, method, spec, rows, queries in block.groups:
        present, stored = vectors[slot]
        stored = stored[with_spec(chunks, spec)[present]]
        if len(stored) == 0:
            continue
        if queries.shape[1] != stored.shape[1]:
            raise ValueError(
                f"vectors of different size: {queries.shape[1]} and {stored.shape[1]}"
            )
        horizon, step = block.horizon[rows], max(1, _CELLS // len(rows))
        for start in range(0, len(stored), step):
            part = stored[start : start + step]
            rough, error = quick_screen(queries, part, method)
            sure = rough <= (horizon - error)[:, None]
            total = np.count_nonzero(sure, axis=1)
            least = np.min(rough, axis=1, initial=np.inf, where=sure)
            largest = np.max(rough, axis=1, initial=-np.inf, where=sure)
            outer = (rough <= (least + 2 * error)[:, None]) | (rough >= (largest - 2 * error)[:, None])
            i, j = np.nonzero(np.where(sure, outer, rough <= (horizon + error)[:, None]))
            low, high = np.full(len(rows), np.inf), np.full(len(rows), -np.inf)
            pairs = max(1, _PAIR_CELLS // max(1, part.shape[1]))
            for at in range(0, len(i), pairs):
                qi, cj = i[at : at + pairs], j[at : at + pairs]
                distance = pair_distances(queries, part, qi, cj, method)
                near = sure[qi, cj] | (distance <= horizon[qi])
                total += np.bincount(qi[near & ~sure[qi, cj]], minlength=len(rows))
                np.minimum.at(low, qi[near], distance[near])
                np.maximum.at(high, qi[near], distance[near])
            yield rows, total, low, high


class HitPool:
    """The nearest hits so far of each request with a ``top``; cut back whenever it doubles."""

    def __init__(self, block: RequestBlock):
        self.block = block
        self.parts: list[pa.Table] = []
        self.rows = 0
        self.kept = 0

    def add(self, r: np.ndarray, distance: np.ndarray, chunks: pa.Table) -> None:
        columns = {"r": pa.array(r), "distance": pa.array(distance)}
        columns |= {name: chunks[name] for name in chunks.column_names}
        self.parts.append(pa.table(columns))
        self.rows += len(r)
        if self.rows > 2 * self.kept + 10_000:
            self.cut()

    def cut(self) -> None:
        hits = in_order(pa.concat_tables(self.parts), "r", "distance", "chunk_id", "tenant")
        r, distance = hits["r"].to_numpy(), hits["distance"].to_numpy()
        place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
        top = self.block.top[r]
        last = place == top - 1
        self.block.worst[r[last]] = distance[last]
        hits = hits.filter(pa.array(place < top)).combine_chunks()
        self.parts, self.rows, self.kept = [hits], len(hits), len(hits)

    def drain(self) -> Iterator[pa.Table]:
        if self.parts:
            self.cut()
            hits = self.parts[0]
            yield self.block.emit(hits["r"].to_numpy(), hits["distance"].to_numpy(), hits)


def listed_hits(block: RequestBlock, batches: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    """All hits of the requests with their ``rank``, held as numbers until all chunks have passed.

    Requests of one id share one list, as in a window by id.
    """
    who, where, far, seen, held = [], [], [], [], 0
    for chunks in batches:
        for r, distance, place in hits(block, chunks):
            who.append(r.astype(np.int32))
            where.append((place + held).astype(np.int32))
            far.append(distance)
        seen.append(chunks.select(["tenant", "chunk_id", "parent_id"]))
        held += len(chunks)
    if not who:
        return
    r, place, distance = np.concatenate(who), np.concatenate(where), np.concatenate(far)
    del who, where, far
    ids = pa.concat_tables(seen).combine_chunks()
    names = block.table["request_id"].combine_chunks().dictionary_encode()
    lists = names.indices.to_numpy(zero_copy_only=False)[r]
    order, starts = in_lists(lists, len(names.dictionary), distance, place, ids)
    lists = lists[order]
    for at in range(0, len(order), EMITTED_ROWS):
        part, mine = order[at : at + EMITTED_ROWS], lists[at : at + EMITTED_ROWS]
        rank = np.arange(at, at + len(part)) - starts[mine] + 1
        out = block.emit(r[part], distance[part], ids.take(pa.array(place[part])))
        yield from out.append_column("rank", pa.array(rank)).to_batches(max_chunksize=10_000)


def in_lists(
    lists: np.ndarray, count: int, distance: np.ndarray, place: np.ndarray, ids: pa.Table
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of hits by list, distance and id, and where each of the ``count`` lists starts (and the last ends)."""
    # numbers of 16 bits are sorted by their digits
    order = np.argsort(lists.astype(np.uint16) if count <= 1 << 16 else lists, kind="stable")
    starts = np.searchsorted(lists[order], np.arange(count + 1), side="left")
    by_id: np.ndarray | None = None
    for start, stop in zip(starts[:-1], starts[1:]):
        mine = order[start:stop]
        far = distance[mine]
        near = np.argsort(far)
        far = far[near]
        if (far[1:] == far[:-1]).any():  # only equal distances are told apart by ids
            if by_id is None:
                by_id = id_order(ids)
            near = np.lexsort((by_id[place[mine]], distance[mine]))
        order[start:stop] = mine[near]
    return order, starts


def id_order(ids: pa.Table) -> np.ndarray:
    """The place of each row in the order of ids."""
    keys = [("chunk_id", "ascending"), ("tenant", "ascending")]
    by_id = np.empty(len(ids), np.int32)
    by_id[pc.sort_indices(ids, sort_keys=keys, null_placement="at_start").to_numpy()] = np.arange(len(ids))
    return by_id


Hit = tuple[np.ndarray, np.ndarray, pa.Table]


def collect_hits(block: RequestBlock, scored: Iterator[Hit]) -> Iterator[pa.RecordBatch]:
    """Pool the hits of requests with a ``top``; pass on the others as they come."""
    pool = HitPool(block)
    for r, distance, found in scored:
        limited = block.limited[r]
        if limited.any():
            pool.add(r[limited], distance[limited], found.filter(pa.array(limited)))
        if not limited.all():
            rest = ~limited
            out = block.emit(r[rest], distance[rest], found.filter(pa.array(rest)))
            yield from out.to_batches(max_chunksize=10_000)
    for out in pool.drain():
        yield from out.to_batches(max_chunksize=10_000)


def _packed(frame: DataFrame, rows: int) -> DataFrame:
    """Rows packed into blocks of at most ``rows``: one row of arrays per block, no shuffle."""
    schema = ", ".join(f"`{f.name}` array<{f.dataType.simpleString()}>" for f in frame.schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                offsets = pa.array([0, part.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, c) for c in part.columns]
                yield pa.RecordBatch.from_arrays(lists, names=part.schema.names)

    return frame.mapInArrow(pack, schema)


def _unpacked(batch: pa.RecordBatch, row: int, prefix: str) -> pa.Table:
    names = [n for n in batch.schema.names if n.startswith(prefix)]
    return pa.table(
        {n[len(prefix) :]: batch.column(n).slice(row, 1).flatten() for n in names}
    )


def _prefixed(frame: DataFrame, prefix: str) -> DataFrame:
    return frame.toDF(*[prefix + c for c in frame.columns])


Process = Callable[[pa.Table, Iterator[pa.Table]], Iterator[pa.RecordBatch]]


def over_blocks(
    chunks: DataFrame,
    requests: DataFrame,
    batch: BatchProfile,
    process: Process,
    ddl: str,
    in_tiles: bool = False,
    listed: int | None = None,
) -> DataFrame:
    """Run ``process(requests, batches of chunks)`` so that all requests meet all chunks.

    With ``listed``, in so many groups, each of which meets all chunks in one task with all requests of an id.
    """
    spark = chunks.sparkSession
    if batch.is_shared and not in_tiles and listed is None:
        shared = spark.sparkContext.broadcast(requests.toArrow())

        def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from process(shared.value, (pa.Table.from_batches([b]) for b in batches))

        return chunks.mapInArrow(scan_batches, ddl)

    if listed is None:
        slots, groups = tile_shape(batch, chunks.count(), tile_count(spark))
    else:
        slots, groups = 1, listed

    def dealt(blocks: DataFrame, no: str, ways: int) -> DataFrame:
        way = F.pmod(F.xxhash64(F.get(no, F.lit(0))), F.lit(ways)).cast("int")
        return blocks.withColumn("way", way).repartitionById(ways, "way").drop("way")

    if listed is None:
        asked = dealt(_prefixed(_packed(requests, DEALT_REQUESTS), "q_"), "q_request_id", groups)
    else:
        asked = _prefixed(_packed(requests.repartition(groups, "request_id"), DEALT_REQUESTS), "q_")
    stored = dealt(_prefixed(_packed(chunks, DEALT_CHUNKS), "c_"), "c_chunk_id", slots)
    met = _tiles(stored, asked)

    def scan_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((tile, row) for tile in batches for row in range(tile.num_rows))
        asked, first = [], []
        for tile, row in rows:
            if tile.column("has_chunks")[row].as_py():
                first.append(_unpacked(tile, row, "c_"))
            if not tile.column("has_requests")[row].as_py():
                break
            asked.append(_unpacked(tile, row, "q_"))
        if asked:
            others = (_unpacked(tile, row, "c_") for tile, row in rows)
            yield from process(pa.concat_tables(asked), _joined_blocks(chain(first, others)))

    return met.mapInArrow(scan_tile, ddl)


def _tiles(stored: DataFrame, asked: DataFrame) -> DataFrame:
    """Each partition of packed chunks with each of packed requests, as one partition: first the blocks of
    requests, beside the first block of chunks, then the other blocks of chunks.

    Both sides are written once, by their shuffles, and every tile reads its partitions from there, so what is
    on disk does not grow with the number of tiles.
    """

    def first(frame: DataFrame) -> Column:
        return frame["no"].bitwiseAND(_IN_PARTITION) == 0

    stored, asked = (f.withColumn("no", F.monotonically_increasing_id()) for f in (stored, asked))
    has_requests, has_chunks = first(stored), first(asked)
    # the left side's rows pass one by one; the right side's partition is kept for them
    pairs = stored.hint("shuffle_replicate_nl").join(asked, has_requests | has_chunks)
    return pairs.select(
        has_requests.alias("has_requests"),
        has_chunks.alias("has_chunks"),
        *[F.when(has_requests, asked[c]).alias(c) for c in asked.columns if c != "no"],
        *[F.when(has_chunks, stored[c]).alias(c) for c in stored.columns if c != "no"],
    )


def request_groups(batch: BatchProfile) -> int:
    """In how many groups a batch must be cut so that the requests and hits of one fit in a task."""
    return max(1, -(-batch.bytes // SMALL_REQUESTS), -(-batch.limited_hits // POOL_ROWS))


def tile_count(spark: SparkSession) -> int:
    """How many tiles keep all cores busy; more of them, as a larger input has partitions, would only send more."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(partitions, TILES_PER_CORE * spark.sparkContext.defaultParallelism)


def tile_shape(batch: BatchProfile, chunks: int, partitions: int) -> tuple[int, int]:
    """Slots of chunks and groups of requests, about as many tiles as ``partitions``.

    A chunk is sent once per group, a request with its hits once per slot. A chunk's vector is taken to
    be as large as a request.
    """
    per_slot = batch.bytes + HIT_BYTES * batch.limited_hits
    per_group = max(1, chunks * batch.bytes // max(1, batch.count))
    best = round(sqrt(partitions * per_slot / per_group))
    groups = max(request_groups(batch), min(best, partitions))
    slots = max(1, partitions // groups)
    return slots, max(groups, partitions // slots)


def _joined_blocks(blocks: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """Dealt blocks put together to what is scored at once."""
    held: list[pa.Table] = []
    for block in blocks:
        held.append(block)
        if sum(map(len, held)) >= BLOCK_CHUNKS:
            yield pa.concat_tables(held)
            held = []
    if held:
        yield pa.concat_tables(held)


def scan(
    chunks: DataFrame,
    requests: DataFrame,
    batch: BatchProfile,
    in_tiles: bool = False,
) -> DataFrame:
    """Hits of every request among the chunks, each request's nearest kept per task.

    ``chunks``: tenant, chunk_id, parent_id, one ``v<slot>`` vector column per named vector and,
    when requests differ in their filters, ``specs`` with the numbers of the filters passed.
    ``requests``: request_id, query_embedding, slot, method, top, auto_limit, horizon, spec.
    """

    def nearest(asked: pa.Table, batches: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        block = RequestBlock(asked)
        return collect_hits(block, (hit for chunks in batches for hit in score(block, chunks)))

    return over_blocks(chunks, requests, batch, nearest, HIT_DDL, in_tiles)


def listed_groups(batch: BatchProfile, chunks: int, total: int, longest: int, partitions: int) -> int | None:
    """In how many groups unbounded lists can be ranked where they are scored; None where they cannot.

    All lists of a group must fit in a task, every task needs requests, and the chunks, which are sent to
    each group, must be less than the hits, which would be sent instead.
    """
    groups = max(partitions, -(-total // LISTED_ROWS))
    sent = groups * chunks * (batch.bytes // max(1, batch.count))
    fits = longest <= LISTED_LONGEST and batch.count >= groups and sent <= total * HIT_BYTES
    return groups if fits else None


def scan_listed(chunks: DataFrame, requests: DataFrame, batch: BatchProfile, groups: int) -> DataFrame:
    """All hits of requests without a ``top``, with their ``rank``. Arguments as for ``scan``."""

    def listed(asked: pa.Table, batches: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        return listed_hits(RequestBlock(asked), batches)

    return over_blocks(chunks, requests, batch, listed, HIT_DDL + ", rank bigint", listed=groups)


CUT_DDL = HIT_DDL + ", rank bigint, settled boolean"


def scan_cut(chunks: DataFrame, requests: DataFrame, batch: BatchProfile) -> DataFrame:
    """``auto_cut_first`` of the nearest ``top`` hits, in the task that scores them: each request meets all chunks there.

    Arguments as for ``scan``, all requests with a ``top`` and an ``auto_limit``, and with ``total, low, high``
    of all their hits. Gives the hits before the cut with their ``rank``; a request whose first hits do not
    hold its cut gives a row that is not ``settled`` instead.
    """

    def cut(asked: pa.Table, batches: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        block = RequestBlock(asked)
        yield from first_cut(block, (hit for chunks in batches for hit in score(block, chunks)))

    groups = max(request_groups(batch), tile_count(chunks.sparkSession))
    return over_blocks(chunks, requests, batch, cut, CUT_DDL, listed=groups)


def first_cut(block: RequestBlock, scored: Iterator[Hit]) -> Iterator[pa.RecordBatch]:
    """Requests of one id share one list, as in a window by id."""
    pool = HitPool(block)
    for r, distance, found in scored:
        pool.add(r, distance, found)
    if not pool.parts:
        return
    pool.cut()
    hits = pool.parts[0]
    names = block.table["request_id"].combine_chunks().dictionary_encode()
    lists = names.indices.to_numpy(zero_copy_only=False)
    if len(names.dictionary) < len(lists):
        shared = hits.append_column("list", pa.array(lists[hits["r"].to_numpy()]))
        hits = in_order(shared, "list", "distance", "chunk_id", "tenant")
    r, distance = hits["r"].to_numpy(), hits["distance"].to_numpy()
    mine = lists[r]
    starts = np.flatnonzero(np.diff(mine, prepend=-1))
    sizes = np.diff(starts, append=len(mine))
    rank = np.arange(len(mine)) - np.repeat(starts, sizes) + 1
    near = rank <= block.top[r]
    if not near.all():
        hits, r, distance, mine, rank = hits.filter(pa.array(near)), r[near], distance[near], mine[near], rank[near]
        starts = np.flatnonzero(np.diff(mine, prepend=-1))
        sizes = np.diff(starts, append=len(mine))
    total, low, high, limit = (block.table[c].to_numpy()[r] for c in ("total", "low", "high", "auto_limit"))
    group = np.cumsum(group_starts(mine, rank, distance, total, low, high))
    group -= np.repeat(group[starts], sizes)  # the first hit starts none
    settled = np.repeat(np.maximum.reduceat(rank, starts), sizes) == total
    settled |= np.repeat(np.maximum.reduceat(group, starts), sizes) >= limit
    kept = np.flatnonzero(settled & (group < limit))
    out = block.emit(r[kept], distance[kept], hits.take(pa.array(kept)))
    out = out.set_column(out.schema.get_field_index("top"), "top", pa.nulls(len(kept), pa.int32()))
    out = out.append_column("rank", pa.array(rank[kept])).append_column("settled", pa.array(np.ones(len(kept), bool)))
    yield from out.to_batches(max_chunksize=10_000)
    open_lists = names.dictionary.take(pa.array(np.unique(mine[~settled])))
    told = {f.name: pa.nulls(len(open_lists), f.type) for f in out.schema}
    told |= {"request_id": open_lists, "settled": pa.array(np.zeros(len(open_lists), bool))}
    yield from pa.table(told).to_batches(max_chunksize=10_000)


def group_starts(
    lists: np.ndarray, rank: np.ndarray, distance: np.ndarray, total: np.ndarray, low: np.ndarray, high: np.ndarray
) -> np.ndarray:
    """Which hits, in order, start a group, as ``auto_cut_first`` has it: those that bulge more than both neighbours."""
    with np.errstate(invalid="ignore", divide="ignore"):
        bulge = (distance - low) / (high - low) - (rank - 1) / (total - 1)
        flat = (high - low == 0) | (total == 1)

    def beyond(step: int) -> np.ndarray:
        """Whether each hit bulges more than the one ``step`` places away in its list; no number is above all, as in Spark."""
        other = np.clip(np.arange(len(lists)) + step, 0, len(lists) - 1)
        there = (lists[other] == lists) & (rank[other] == rank + step) & ~flat & ~flat[other]
        return there & ((bulge > bulge[other]) | (np.isnan(bulge) & ~np.isnan(bulge[other])))

    return beyond(-1) & np.where(rank == total, beyond(-2), beyond(1))


SPREAD_DDL = "request_id string, total bigint, low double, high double"


def spreads(chunks: DataFrame, requests: DataFrame, batch: BatchProfile) -> DataFrame:
    """``request_id, total, low, high``: number, least and largest distance of all hits per request.

    Arguments as for ``scan``, of requests without a ``top``. Pairs are counted where they are
    scored; a task sends one row per request.
    """

    def measure(asked: pa.Table, batches: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        block = RequestBlock(asked)
        size = len(asked)
        total, low, high = np.zeros(size, np.int64), np.full(size, np.inf), np.full(size, -np.inf)
        for part in batches:
            for rows, number, least, largest in measures(block, part):
                total[rows] += number
                low[rows] = np.minimum(low[rows], least)
                high[rows] = np.maximum(high[rows], largest)
        met = np.flatnonzero(total)
        names = asked["request_id"].combine_chunks().take(pa.array(met))
        columns = [names, pa.array(total[met]), pa.array(low[met]), pa.array(high[met])]
        yield pa.RecordBatch.from_arrays(columns, names=["request_id", "total", "low", "high"])

    partial = over_blocks(chunks, requests, batch, measure, SPREAD_DDL)
    return partial.groupBy("request_id").agg(
        F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )
