"""Near-duplicates by MinHash bands, odd sketches and exact confirmation.

A document is the set of its distinct ``width``-word shingles (64-bit hashes). Two documents are linked
if the Jaccard similarity of their sets is ``similarity`` or more; groups are connected components.

1. Documents with equal sets are one node, so copies are never compared.
2. ``bands`` x ``rows`` MinHash values give each node its buckets. With 32 x 4, two sets of similarity
   0.8 miss each other in all buckets with probability 5e-8.
3. A second MinHash (one permutation cut into bins, the least value of each) is folded into an odd
   sketch: a bitmap in which every sample flips one bit. The population count of two sketches' XOR
   estimates how many samples differ; a pair is a candidate if the shared part of both sets' samples
   is less than ``SLACK``, more than six standard deviations, below what the similarity gives. Sets of
   up to ``FINE_SIZE`` shingles have a sketch over more bins, which estimates closer.
4. Candidates are confirmed on their full sets.

No bucket's pairs are all emitted. Round one links each node to the best of its buckets' smallest
members. What is left are buckets that still hold several components: in the next round each member
proposes its best partner of another component, and the last round proposes all remaining candidates,
so no link between two components is lost. A pair is proposed in the first of its buckets only. Large buckets are compared block against block.

Defined cases: a text of fewer words is one shingle; a null or empty text has an empty set, is linked
with nothing and is its own group; a null id takes part, but a group is named by its smallest id that
is not null; rows that repeat an id are each judged by their text; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, WordIds, binary_text, kept_in_process, map_columns, mixed, text_digest, window_hashes
from chunkloom.operators.storage import remove, staged

BANDS, ROWS = 32, 4
BITS = 4096
BINS = (1 << 16, 1 << 12)  # of the fine sketch and the coarse one
FINE_SIZE = 1000
SLACK = (0.009, 0.026)
BLOCK = 1000  # members of a bucket that are compared at once

_SEEDS = np.random.default_rng(77).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64)
_FACTORS = _SEEDS[0] * np.uint64(2) + np.uint64(1)
_SHIFTS = _SEEDS[1]


def shingle_set(words: list[bytes], width: int, ids: WordIds) -> np.ndarray:
    """Sorted distinct hashes; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    size = min(width, len(words))
    return np.unique(window_hashes(ids(words), size, size))


def band_keys(values: np.ndarray) -> np.ndarray:
    """A key for each band of the MinHash signature."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(values), 2048):
            least = np.minimum(least, (values[i : i + 2048, None] * _FACTORS + _SHIFTS).min(0))
        weighed = least.reshape(BANDS, ROWS) * _FACTORS[:ROWS]
        return mixed(weighed.sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def odd_sketch(values: np.ndarray, bins: int) -> tuple[bytes, int]:
    """The parity bitmap of the MinHash samples, and their number."""
    with np.errstate(over="ignore"):
        ranked = np.sort(mixed(values + np.uint64(0x9E3779B97F4A7C15)))
        place = ranked >> np.uint64(65 - bins.bit_length())
        samples = ranked[np.concatenate([[True], place[1:] != place[:-1]])]
        bits = np.bincount((mixed(samples * np.uint64(3)) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes(), len(samples)


def sketches(values: np.ndarray) -> tuple[bytes, int, int]:
    """The fine and the coarse sketch, each left empty where no comparison uses it, and their samples."""
    empty = (bytes(BITS // 8), 0)
    fine = odd_sketch(values, BINS[0]) if len(values) <= FINE_SIZE else empty
    coarse = odd_sketch(values, BINS[1]) if 2 * len(values) > FINE_SIZE else empty
    return fine[0] + coarse[0], fine[1], coarse[1]


def shared_part(differing_bits: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """Estimated share of samples that two sets have in common, of the ``samples`` of both together."""
    odd = np.minimum(2 * differing_bits / BITS, 1 - 1 / BITS)
    differing = np.log1p(-odd) / np.log1p(-2 / BITS)
    return (samples - differing) / 2 / np.maximum(samples, 1)


class Members:
    """Sizes and sketches of nodes, in rows."""

    def __init__(self, size, fine, coarse, sketch: list[bytes]):
        self.size = np.asarray(size, np.int64)
        self.samples = np.stack([np.asarray(fine, np.int64), np.asarray(coarse, np.int64)], 1)
        self.bits = np.frombuffer(b"".join(sketch), np.uint64).reshape(len(self.size), 2, -1)

    def near(self, i: np.ndarray, other: Members, j: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs ``i, j`` can have the similarity, and how much their samples share.

        By their sizes, and by the estimate with its slack.
        """
        a, b = self.size[i], other.size[j]
        kind = np.where(np.maximum(a, b) <= FINE_SIZE, 0, 1)
        differ = np.bitwise_count(self.bits[i, kind] ^ other.bits[j, kind]).sum(1, dtype=np.int64)
        samples = self.samples[i, kind] + other.samples[j, kind]
        bins = np.array(BINS)[kind]

        def filled(size: np.ndarray) -> np.ndarray:
            return bins * -np.expm1(size * np.log1p(-1 / bins))

        wanted = similarity * filled((a + b) / (1 + similarity)) / (filled(a) + filled(b))
        part = shared_part(differ, samples)
        close = part >= wanted - np.array(SLACK)[kind] - 1.5 / np.maximum(samples, 1)
        return close & (np.minimum(a, b) >= (similarity - 1e-9) * np.maximum(a, b)), part


def features(docs: DataFrame, width: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, node, fine, coarse, sketch, keys``; the node is a digest of the set."""
    id_type = docs.schema[id_column].dataType.simpleString()
    ddl = f"doc_id {id_type}, n_shingles bigint, node binary, fine int, coarse int, sketch binary, keys array<bigint>"

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        ids = kept_in_process("word-ids", None, WordIds)
        for batch in batches:
            names = ("n_shingles", "node", "fine", "coarse", "sketch", "keys")
            out: Columns = {"doc_id": batch.column(0), **{n: [] for n in names}}
            for text in batch.column(1).to_pylist():
                values = shingle_set(text.lower().split(), width, ids)
                sketch, fine, coarse = sketches(values) if len(values) else (None, 0, 0)
                out["n_shingles"].append(len(values))
                out["node"].append(blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                out["fine"].append(fine)
                out["coarse"].append(coarse)
                out["sketch"].append(sketch)
                out["keys"].append(band_keys(values) if len(values) else None)
            yield out

    return map_columns(docs.select(F.col(id_column).alias("doc_id"), binary_text(text_column).alias("text")), ddl, worker)


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node, hashes`` for one document of every wanted node (``doc_id, node``)."""
    picked = docs.select("doc_id", binary_text().alias("text")).alias("d")
    joined = picked.join(wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))).select("w.node", "text")

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        ids = kept_in_process("word-ids", None, WordIds)
        for batch in batches:
            nodes, hashes = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = shingle_set(text.lower().split(), width, ids).tobytes()
                if blake2b(values, digest_size=16).digest() == node:  # an id can have several texts
                    nodes.append(node)
                    hashes.append(values)
            yield {"node": nodes, "hashes": hashes}

    return map_columns(joined, "node binary, hashes binary", worker).dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b, linked`` from the full sets of both."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("in_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("in_b"))
    percent = round(100 * similarity)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield {"a": batch.column(0), "b": batch.column(1), "linked": linked}

    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "in_a", "in_b")
    return map_columns(rows, "a binary, b binary, linked boolean", worker)


def components(links: DataFrame, scratch: list[str]) -> DataFrame:
    """``node, label``: the smallest node that each linked node can reach.

    Each round takes the least label among the neighbours and then the label of that label, so the
    rounds grow with the logarithm of the longest path.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, copy = staged(both, "links")
    scratch.append(copy)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels, copy = staged(labels.withColumn("label", F.least("node", "label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        via = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        after = lower.join(via, "label", "left").select("node", F.least("label", "far").alias("label"), "old")
        after, new_copy = staged(after, "labels")
        remove(labels.sparkSession, copy)
        labels, copy = after.drop("old"), new_copy
        if after.where("label < old").isEmpty():
            scratch.append(copy)
            return labels


def _proposals(members: DataFrame, similarity: float, best_only: bool) -> DataFrame:
    """``a, b``: candidate pairs of different components in the same bucket.

    A bucket is dealt out as pairs of blocks of about ``BLOCK`` members, each a group of rows that a
    task reads one after the other. With ``best_only`` each member proposes its best partner there.
    """
    dealt = members.withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.struct("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    dealt = dealt.select(group.alias("g"), "block", "node", "label", "keys", "size", "fine", "coarse", "sketch")
    dealt = dealt.repartition("g").sortWithinPartitions("g")

    def pairs_of(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        g, block, node, label, keys, *about = zip(*rows, strict=True)
        number = {x: i for i, x in enumerate(dict.fromkeys(label))}
        label, block, keys = np.array([number[x] for x in label]), np.array(block), np.array(keys)
        members = Members(*about)
        band = int(np.flatnonzero(keys[0] == g[0][0])[0])
        one_block = g[0][1] == g[0][2]
        out = []
        for k in range(len(rows)):
            other = label != label[k]
            if not one_block:
                other &= block != block[k]
            if not best_only:
                other[: k + 1] = False
                other &= ~(keys[:, :band] == keys[k, :band]).any(1)
            at = np.flatnonzero(other)
            if not len(at):
                continue
            near, part = members.near(at, members, np.full(len(at), k), similarity)
            at, part = at[near], part[near]
            if best_only and len(at):
                at = at[[int(np.argmax(part))]]
            out += [(min(node[k], node[i]), max(node[k], node[i])) for i in at]
        return out

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        here, rows, found = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                group = tuple(row[0].values())
                if group != here:
                    if rows:
                        found += pairs_of(rows)
                    here, rows = group, []
                    if len(found) > 100_000:
                        yield {"a": [a for a, _ in found], "b": [b for _, b in found]}
                        found = []
                rows.append((group, *row[1:]))
        if rows:
            found += pairs_of(rows)
        yield {"a": [a for a, _ in found], "b": [b for _, b in found]}

    return map_columns(dealt, "a binary, b binary", worker).distinct()


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    similarity: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per document.

    ``component_id`` is the smallest id of the group and ``kept`` marks the rows with that id.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    feats, _ = staged(features(docs, width), "features")
    scratch: list[str] = []

    def keep(frame: DataFrame, name: str) -> DataFrame:
        frame, copy = staged(frame, name)
        scratch.append(copy)
        return frame

    sets_of = feats.where("node IS NOT NULL")
    firsts = keep(sets_of.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")
    first = F.col("f.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("f.node") == F.col("n.node"))
    nodes = sets_of.alias("f").join(firsts.alias("n"), first, "left_semi")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    buckets = keep(keyed.join(shared.where("leader < last").drop("last"), "key").distinct(), "buckets")
    candidates = keep(buckets.select("node").distinct(), "candidates")
    about = keep(
        sets_of.join(candidates, "node", "left_semi")
        .groupBy("node")
        .agg(F.first("n_shingles").alias("size"), *[F.first(c).alias(c) for c in ("fine", "coarse", "sketch", "keys")]),
        "sketches",
    )
    sets = keep(full_sets(docs, firsts.join(candidates, "node", "left_semi"), width), "sets")

    # round one: the best of the leaders
    star = buckets.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    named = [about.drop("keys").toDF(*[f"{c}_{side}" for c in about.drop("keys").columns]) for side in "ab"]
    star = star.join(named[0], F.col("a") == F.col("node_a")).join(named[1], F.col("b") == F.col("node_b"))
    best = _closest(star, similarity)
    checked = keep(confirmed(best, sets, similarity), "checked")
    labels = components(checked.where("linked"), scratch)
    for best_only in (True, False):
        members = buckets.select("key", "node").join(labels, "node", "left")
        members = members.withColumn("label", F.coalesce("label", "node"))
        sizes = members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"))
        blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
        members = members.join(sizes.where("x < y").select("key", blocks), "key").join(about, "node")
        proposed = _proposals(members, similarity, best_only).join(checked.select("a", "b"), ["a", "b"], "left_anti")
        new = keep(confirmed(proposed, sets, similarity), "checked")
        checked = checked.union(new)
        if not new.where("linked").isEmpty():
            labels = components(checked.where("linked"), scratch)

    labels, _ = staged(labels, "groups")
    for used in scratch:
        remove(spark, used)
    grouped = sets_of.select("doc_id", "n_shingles", "node").join(labels, "node", "left")
    grouped = grouped.withColumn("label", F.coalesce("label", "node"))
    names = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    grouped = grouped.join(names, "label").select("doc_id", "n_shingles", "component_id")
    alone = feats.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _closest(star: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: for every ``b`` the leader ``a`` of the nearest sketch among its candidates."""
    columns = ["a", "b", *[f"{c}_{side}" for side in "ab" for c in ("size", "fine", "coarse", "sketch")]]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            if batch.num_rows:
                a, b = (Members(*(batch.column(i).to_pylist() for i in range(first, first + 4))) for first in (2, 6))
                rows = np.arange(batch.num_rows)
                near, part = a.near(rows, b, rows, similarity)
                mask = pa.array(near)
                yield {"a": batch.column(0).filter(mask), "b": batch.column(1).filter(mask), "share": part[near]}

    near = map_columns(star.select(*columns), "a binary, b binary, share double", worker)
    # among equals the smallest leader, so that a group has one centre
    best = near.groupBy("b").agg(F.min(F.struct(-F.col("share"), "a")).alias("best"))
    return best.select("best.a", "b")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents that are kept, their columns as they are: one row of every group.

    It is the row of the smallest id that is not null. Of different texts with that id, or of a group
    without ids, it is the text with the smallest digest, and of rows that repeat id and text any one.
    Rows without words are their own groups and stay.
    """
    digest = text_digest(text_column)
    # ids that are null or repeated do not tell rows apart; with the digests of their texts they do
    key = F.struct(F.when(F.col(id_column).isNull(), 1).alias("missing"), F.col(id_column).alias("id"), digest.alias("digest"))
    groups = near_duplicates(docs.select(key.alias("doc_id"), F.col(text_column).alias("text")), **options)
    kept = groups.where("kept").groupBy(F.col("doc_id.id").alias("__kept_id"), F.col("doc_id.digest").alias("__kept_digest"))
    kept, _ = staged(kept.agg(((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("__repeated")), "kept")
    same = F.col(id_column).eqNullSafe(F.col("__kept_id")) & (digest == F.col("__kept_digest"))
    left = docs.join(kept.where("NOT __repeated"), same, "left_semi")
    repeated = kept.where("__repeated")
    if repeated.isEmpty():
        return left
    again = docs.join(repeated, same).dropDuplicates(["__kept_id", "__kept_digest"])
    return left.union(again.select(*[again[f"`{c}`"] for c in docs.columns]))
