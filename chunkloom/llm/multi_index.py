"""Hard negatives by an inverted multi-index with certified windows.

Index. Vectors are cut in half, and each half is given to the nearest centre of its codebook; a pair of
codes is a cell. The codebooks are fitted on ``SAMPLE`` rows (those with the smallest hashes), every row
is indexed. Rows are sorted by cell, label and id and packed into blocks of up to ``BLOCK_ROWS``; each
block knows, for every code it holds, the largest distance of a row's half from the centre.

Search. A centre's inner product with half an anchor, plus the anchor half's length times that radius,
bounds the half-score of all rows with the code. A heap walks the sums of the two descending lists of
half-score bounds (multi-sequence), so that cells come by falling bound, and stops once nothing that is
still to come can matter: for positives, when the bound is below the last of the wanted; for negatives,
when every window is certified, that is it has its rows and the bound is below the last of them, or the
bound is below the window. Cells whose lower bounds are above all windows are passed over unread. So the
result is exact, whatever the codebooks are; these only decide how much is read.

On the cluster every block of anchors meets every block of the index (a query set against all rows, in
blocks): anchors are copied to ``slots``, blocks of the index are dealt out among them, and an equi-join
on the slot brings them together. Only a block's best rows leave a task.

Defined cases: rows without id, label or vector, or with a component that is null or not finite, take no
part, nor do vectors of another length than the most frequent one (the longer of equally frequent ones);
rows that repeat an id, a label and a vector count once; of rows that share an id otherwise each is an
anchor of its own, and none is another's positive or negative; an empty table gives no rows; a score that
is no 64-bit number raises ``OverflowError``. Of the input only the three columns are read. Memory: one
block of the index and one of anchors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, lists, map_columns
from chunkloom.operators.storage import staged

SAMPLE = 4096
CELL_ROWS = 128
MOST_CODES = 64
BLOCK_ROWS = 4096
ANCHOR_ROWS = 256
Best = list[tuple[int, int]]  # (-score, id), the best first


def scaled(embeddings: DataFrame, scale: float = 256.0) -> DataFrame:
    """``vec_id, label, vector``: rows that take part, with components ``floor(scale * x)`` as integers."""
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.transform("embedding", lambda x: x.cast("double") * scale).alias("vector"),
    )
    unfit = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(~unfit)
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x).cast("bigint")))


def fit_centres(points: np.ndarray, n_codes: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from evenly spread starting points; the same points give the same centres."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    starts = np.unique(points, axis=0)
    centres = starts[np.linspace(0, len(starts) - 1, min(n_codes, len(starts))).astype(int)]
    for _ in range(rounds):
        code = nearest(points, centres)
        count = np.bincount(code, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, code, points)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * (points @ centres.T), axis=1)


def halves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = points.shape[1] // 2
    return points[:, :cut], points[:, cut:]


class Block:
    """Rows of the index by cell, with the bounds of the halves."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, centres: tuple[np.ndarray, np.ndarray]):
        points = vectors.astype(float)
        self._longest = np.sqrt((points**2).sum(1)).max(initial=0)
        self._largest = float(np.abs(points).max(initial=0))
        self.sides = []
        codes = []
        for half, centre in zip(halves(points), centres, strict=True):
            code = nearest(half, centre)
            present, place = np.unique(code, return_inverse=True)
            far = np.sqrt(((half - centre[code]) ** 2).sum(1))
            radius = np.zeros(len(present))
            np.maximum.at(radius, place, far)
            self.sides.append((centre[present], radius))
            codes.append(place)
        cell = codes[0] * len(self.sides[1][0]) + codes[1]
        # rows come sorted, but codes of rows right between two centres may have come out otherwise
        order = np.lexsort((ids, labels, cell))
        cell, self.ids, self.labels = cell[order], ids[order], labels[order]
        self._points, self._vectors = points[order], vectors[order]
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, int)
        self.cells = dict(zip(cell[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True), strict=True))

    def bounds(self, anchors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Upper and lower bounds of both half-scores for each anchor, and what rounding may cost."""
        upper, lower = [], []
        for half, (centre, radius) in zip(halves(anchors), self.sides, strict=True):
            middle = half @ centre.T
            reach = np.sqrt((half**2).sum(1))[:, None] * radius
            upper.append(middle + reach)
            lower.append(middle - reach)
        slack = 1e-6 + 1e-9 * np.sqrt((anchors**2).sum(1)) * self._longest
        return upper, lower, slack

    def scores(self, start: int, stop: int, anchor: np.ndarray) -> np.ndarray:
        # sums of up to 2 ** 53 are exact as floats; others are done with Python's integers
        if float(np.abs(anchor).max(initial=0)) * self._largest * len(anchor) < 2**53:
            return (self._points[start:stop] @ anchor.astype(float)).astype(np.int64)
        whole = self._vectors[start:stop].astype(object) @ anchor.astype(object)
        if any(abs(s) >= 2**63 for s in whole):
            raise OverflowError("a score is no 64-bit number")
        return whole.astype(np.int64)


def falling_cells(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of places in two lists of bounds, by falling sum: ``sum, place, place``."""
    rows, columns = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    a, b = first[rows].tolist(), second[columns].tolist()
    done = [0] * len(a)  # how many of each row have been taken; a row's pairs are taken in order
    heap = [(-(a[0] + b[0]), 0, 0)] if a and b else []
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, rows[i], columns[j]
        done[i] = j + 1
        # a pair comes up once both pairs before it have been taken
        if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if i + 1 < len(a) and done[i + 1] == j:
            heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))


def _add(best: Best, scores: np.ndarray, ids: np.ndarray, wanted: int) -> Best:
    if len(scores) > 4 * wanted:  # the others cannot be among the best, whatever their ids are
        last = -np.partition(-scores, wanted - 1)[wanted - 1]
        ids, scores = ids[scores >= last], scores[scores >= last]
    return sorted([*best, *zip((-scores).tolist(), ids.tolist(), strict=True)])[:wanted]


def best_alike(block: Block, anchor: np.ndarray, own: int, label: int, wanted: int, bounds) -> Best:
    """The best rows of the anchor's label."""
    (first, second), _, slack = bounds
    best: Best = []
    width = len(second)
    for bound, i, j in falling_cells(first, second):
        if len(best) == wanted and bound + slack < -best[-1][0]:
            break
        if (cell := block.cells.get(i * width + j)) is None:
            continue
        start, stop = cell
        start, stop = start + np.searchsorted(block.labels[start:stop], [label, label + 1])
        if start == stop:
            continue
        scores, ids = block.scores(start, stop, anchor), block.ids[start:stop]
        fit = ids != own
        if len(best) == wanted:
            fit &= scores >= -best[-1][0]
        if fit.any():
            best = _add(best, scores[fit], ids[fit], wanted)
    return best


def best_in_windows(
    block: Block, anchor: np.ndarray, own: int, label: int, windows: list[tuple[int, int]], wanted: int, bounds
) -> list[Best]:
    """For each window (lowest, highest score) the best rows of other labels."""
    (first, second), (low_first, low_second), slack = bounds
    found: list[Best] = [[] for _ in windows]
    floors = [low for low, _ in windows]  # rows below are of no use
    open_windows = [k for k, (low, high) in enumerate(windows) if low <= high]
    width = len(second)
    for bound, i, j in falling_cells(first, second):
        open_windows = [k for k in open_windows if bound + slack >= floors[k]]
        if not open_windows:
            break
        if (cell := block.cells.get(i * width + j)) is None:
            continue
        top = max(windows[k][1] for k in open_windows)
        if low_first[i] + low_second[j] - slack > top:
            continue
        start, stop = cell
        scores, ids = block.scores(start, stop, anchor), block.ids[start:stop]
        fit = (scores >= min(floors[k] for k in open_windows)) & (scores <= top)
        fit &= (block.labels[start:stop] != label) & (ids != own)
        if not fit.any():
            continue
        scores, ids = scores[fit], ids[fit]
        for k in open_windows:
            inside = (scores >= floors[k]) & (scores <= windows[k][1])
            if inside.any():
                found[k] = _add(found[k], scores[inside], ids[inside], wanted)
                if len(found[k]) == wanted:
                    floors[k] = max(floors[k], -found[k][-1][0])
    return found


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores ``s`` with ``low * score <= 100 * s <= high * score``."""
    return -(-low * score // 100), high * score // 100


def _matrix(packed: bytes, width: int) -> np.ndarray:
    return np.frombuffer(packed, "<i8").reshape(-1, width)


def _coded(rows: DataFrame, width: int, centres: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``cell, vec_id, label, vector`` with the vectors packed."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            vectors = batch.column(2).flatten().to_numpy().astype("<i8").reshape(-1, width)
            first, second = (nearest(h, c) for h, c in zip(halves(vectors.astype(float)), centres, strict=True))
            yield {
                "cell": first * len(centres[1]) + second,
                "vec_id": batch.column(0),
                "label": batch.column(1),
                "vector": [v.tobytes() for v in vectors],
            }

    return map_columns(rows.select("vec_id", "label", "vector"), "cell bigint, vec_id bigint, label bigint, vector binary", worker)


def build_index(rows: DataFrame, width: int, centres: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``block, ids, labels, vectors``: the packed blocks of the index."""
    key = ["cell", "label", "vec_id"]
    ordered = _coded(rows, width, centres).repartitionByRange(*key).sortWithinPartitions(*key, "vector")

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        block = TaskContext.get().partitionId()
        ids, labels, vectors, last = [], [], [], None

        def packed() -> Columns:
            row = (block, np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), b"".join(vectors))
            return lists([row], ["block", "ids", "labels", "vectors"])

        for batch in batches:
            for _, vec_id, label, vector in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (vec_id, label, vector) == last:
                    continue
                last = (vec_id, label, vector)
                ids.append(vec_id)
                labels.append(label)
                vectors.append(vector)
                if len(ids) == BLOCK_ROWS:
                    yield packed()
                    block, ids, labels, vectors = block + 1, [], [], []
        if ids:
            yield packed()

    return map_columns(ordered, "block bigint, ids binary, labels binary, vectors binary", worker)


def _numbered(anchors: DataFrame, width: int, centres: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``anchor, vec_id, label, vector``: each distinct anchor with a number."""
    distinct = _coded(anchors, width, centres).drop("cell").dropDuplicates()
    return distinct.withColumn("anchor", F.monotonically_increasing_id())


def _meet(index: DataFrame, anchors: DataFrame, slots: int, columns: list[str]) -> DataFrame:
    """Every block of anchors beside every block of the index."""
    grouped = anchors.groupBy(F.expr(f"anchor div {ANCHOR_ROWS}").alias("group"))
    blocks = grouped.agg(F.collect_list(F.struct(*columns)).alias("anchors"))
    copied = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).drop("group")
    dealt = index.withColumn("slot", F.pmod("block", F.lit(slots)).cast("int"))
    return dealt.repartition(slots, "slot").join(copied.repartition(slots, "slot"), "slot")


def _search(pairs: DataFrame, width: int, centres, ddl: str, look) -> DataFrame:
    """``look(block, vectors, anchors, bounds)`` gives the rows for each pair of blocks."""
    names = [part.split()[0] for part in ddl.split(", ")]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        here, block = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                key, ids, labels, vectors, anchors = (batch.column(i)[row].as_py() for i in range(5))
                if (key, ids) != here:
                    here = (key, ids)
                    block = Block(_matrix(vectors, width), np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), centres)
                asked = np.concatenate([_matrix(a["vector"], width) for a in anchors])
                yield lists(list(look(block, asked, anchors)), names)

    return map_columns(pairs.select("block", "ids", "labels", "vectors", "anchors"), ddl, worker)


def _each(block: Block, asked: np.ndarray) -> Iterator[tuple]:
    upper, lower, slack = block.bounds(asked.astype(float))
    for t in range(len(asked)):
        yield tuple(u[t] for u in upper), tuple(w[t] for w in lower), slack[t]


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    n_codes: int | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` and ``anchors`` are as :func:`scaled` gives them. Positives are an anchor's best rows of its
    label, negatives of a positive the best rows of other labels whose score is between ``low`` and
    ``high`` percent of the positive's.
    """
    spark = rows.sparkSession
    lengths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width, count = (lengths["width"], lengths["count"]) if lengths and lengths["width"] else (1, 0)
    rows, anchors = (f.where(F.size("vector") == width) for f in (rows, anchors))
    sample = rows.select("vector").orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE).toArrow()
    points = sample["vector"].combine_chunks().flatten().to_numpy().astype(float).reshape(-1, width)
    codes = n_codes or min(MOST_CODES, max(2, int((count / CELL_ROWS) ** 0.5)))
    centres = tuple(fit_centres(half, codes) for half in halves(points))

    index, _ = staged(build_index(rows, width, centres), "multi-index")
    asked, _ = staged(_numbered(anchors, width, centres), "anchors")
    n_blocks = index.count()
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slots = max(1, min(n_blocks, 4 * tasks))

    def alike(block: Block, vectors: np.ndarray, given: list[dict]) -> Iterator[tuple]:
        for a, vector, bounds in zip(given, vectors, _each(block, vectors), strict=True):
            for score, own in best_alike(block, vector, a["vec_id"], a["label"], n_positives, bounds):
                yield a["anchor"], own, -score

    ddl = "anchor bigint, positive_id bigint, positive_score bigint"
    near = _search(_meet(index, asked, slots, ["anchor", "vec_id", "label", "vector"]), width, centres, ddl, alike)
    best = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    positives = near.withColumn("k", F.row_number().over(best)).where(F.col("k") <= n_positives)
    listed = positives.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("k", "positive_id", "positive_score"))).alias("positives")
    )
    given, _ = staged(asked.join(listed, "anchor"), "anchors-positives")

    def unlike(block: Block, vectors: np.ndarray, given: list[dict]) -> Iterator[tuple]:
        for a, vector, bounds in zip(given, vectors, _each(block, vectors), strict=True):
            windows = [window_of(p["positive_score"], low, high) for p in a["positives"]]
            found = best_in_windows(block, vector, a["vec_id"], a["label"], windows, n_negatives, bounds)
            for p, best in zip(a["positives"], found, strict=True):
                for score, other in best:
                    yield a["anchor"], a["vec_id"], p["k"], p["positive_id"], p["positive_score"], other, -score

    ddl = (
        "anchor bigint, anchor_id bigint, k int, positive_id bigint, positive_score bigint, "
        "negative_id bigint, negative_score bigint"
    )
    columns = ["anchor", "vec_id", "label", "vector", "positives"]
    hard = _search(_meet(index, given, slots, columns), width, centres, ddl, unlike)
    best = Window.partitionBy("anchor", "k").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
