"""The prefix trie of conversations: ternary search trees over range shards, merged at their boundaries.

1. A turn is known by a digest of role and text, a conversation by the digests of its turns in order.
   Texts do not travel further than that.
2. Conversations are dealt out by range of (digests, id), so a shard holds neighbours of the trie, and
   copies of one conversation are split among shards by their ids. A shard of more than ``RUN_TURNS``
   turns is worked off in runs.
3. A run numbers its digests (its dictionary), and puts its distinct sequences into a ternary search
   tree, the median first, then the medians of both halves, so that every level's tree is balanced. One
   pass with a stack over the tree adds up members, leaves and savings from the bottom.
4. Only nodes on the path of a run's first or last sequence can also lie in another run. They leave as
   partial rows and are merged by key, a digest of the path. Leaves and savings of subtrees add up but
   for what each boundary node counts once however many runs hold it; the run with the smallest number
   accounts for that, along its two paths. All other nodes are whole within their run.
5. The ids of conversations that end in a boundary node come in pieces, one per run, in ascending order,
   and are hashed piece after piece.

Defined cases: rows with a null id are no conversation; a null role or text is empty; null turns come
first, and rows of one conversation with the same turn are ordered by the digest of role and text; rows
that repeat are turns of their own; no conversations give no nodes, not even a root. Of the input only
the four columns are read. Memory: one conversation, 16 bytes and a size a turn (as one text elsewhere),
and the nodes of one run. A hash runs over all ids that end in one node, so these pass, as pieces of up
to ``PIECE_IDS`` ids, through one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, lists, map_columns
from chunkloom.operators.storage import staged

RUN_TURNS = 200_000
PIECE_IDS = 50_000
SALTS = 32
DIGEST = 16
ROOT = bytes(DIGEST)
NO_ENDS = sha256(b"").hexdigest()
GROUP = 5
HEADS = 9
INNER, BOUNDARY, PIECE = 0, 1, 2
_ROW = (
    "kind int, node binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, run bigint, branch int, "
    "size bigint, ids binary"
)
_NAMES = [part.split()[0] for part in _ROW.split(", ")]


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order, as digest (hex) and bytes of text."""
    role, text = (F.coalesce(F.col(c).cast("binary"), F.lit(b"").cast("binary")) for c in ("role", "text"))
    length = F.concat(F.octet_length(role).cast("string"), F.lit(":")).cast("binary")
    turn = F.struct("turn", F.md5(F.concat(length, role, text)).alias("digest"), F.octet_length(text).cast("bigint").alias("size"))
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", turn.alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"], t["size"])))


def rebuilt(found: DataFrame) -> DataFrame:
    """Conversations that begin like the first one of their group of five ids.

    Of conversation ``c`` the first ``crc32(c) % 9`` turns are replaced by as many of ``c - c % 5``; all
    of them if that has fewer, none if there is no such conversation.
    """
    first = found.where(F.col("conv_id") % GROUP == 0)
    first = first.select(F.col("conv_id").alias("of"), F.slice("turns", 1, HEADS - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    own = F.slice("turns", taken + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.coalesce(F.slice("head", F.lit(1), taken), F.filter("turns", lambda t: F.lit(False)))
    joined = found.join(first, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("of"), "left")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


class TernaryTree:
    """Sequences of numbers as a ternary search tree; node 0 is the root of the trie, the empty prefix.

    ``low`` and ``high`` lead to other continuations of the same prefix, ``equal`` to what follows.
    """

    def __init__(self):
        self.number, self.low, self.equal, self.high, self.ends = [-1], [-1], [-1], [-1], [-1]

    def insert(self, sequence: list[int], payload: int) -> None:
        number, low, equal, high = self.number, self.low, self.equal, self.high
        node = 0
        for wanted in sequence:
            links, place, at = equal, node, equal[node]
            while at >= 0 and number[at] != wanted:
                links = low if wanted < number[at] else high
                place, at = at, links[at]
            if at < 0:
                at = len(number)
                links[place] = at
                number.append(wanted)
                for new in (low, equal, high, self.ends):
                    new.append(-1)
            node = at
        self.ends[node] = payload

    def walk(self) -> tuple[list[int], list[int]]:
        """All nodes, parents in the trie before their children, and the parent of each."""
        order, parents = [], []
        stack = [(0, -1)]
        while stack:
            node, parent = stack.pop()
            order.append(node)
            parents.append(parent)
            if self.low[node] >= 0:
                stack.append((self.low[node], parent))
            if self.high[node] >= 0:
                stack.append((self.high[node], parent))
            if self.equal[node] >= 0:
                stack.append((self.equal[node], node))
        return order, parents

    def path(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence that is in the tree, from the root."""
        nodes = [0]
        for wanted in sequence:
            at = self.equal[nodes[-1]]
            while self.number[at] != wanted:
                at = self.low[at] if wanted < self.number[at] else self.high[at]
            nodes.append(at)
        return nodes


def median_first(count: int) -> Iterator[int]:
    """0 to ``count - 1``: the median, then the medians of both halves, and so on."""
    stack = [(0, count)]
    while stack:
        start, stop = stack.pop()
        if start < stop:
            middle = (start + stop) // 2
            yield middle
            stack.append((middle + 1, stop))
            stack.append((start, middle))


def trie_rows(paths: list[bytes], ids: list[int], sizes: list[list[int]], run: int) -> Iterator[list[tuple]]:
    """The rows of one run, whose conversations are sorted by path and id."""
    starts = [i for i in range(len(paths)) if i == 0 or paths[i] != paths[i - 1]]
    members = [ids[a:b] for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]
    digests = np.array([paths[i][a : a + DIGEST] for i in starts for a in range(0, len(paths[i]), DIGEST)], f"S{DIGEST}")
    dictionary, numbers = np.unique(digests, return_inverse=True)
    spelled = [d.ljust(DIGEST, b"\0") for d in dictionary.tolist()]  # numpy drops zeros at the end
    edges = np.concatenate([[0], np.cumsum([len(paths[i]) // DIGEST for i in starts])]).tolist()
    numbers = numbers.reshape(-1).tolist()
    groups = [numbers[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    size_of = [0] * len(spelled)
    for i, group in zip(starts, groups, strict=True):
        for number, size in zip(group, sizes[i], strict=True):
            size_of[number] = size

    tree = TernaryTree()
    for i in median_first(len(groups)):
        tree.insert(groups[i], i)
    first, last = tree.path(groups[0]), tree.path(groups[-1])
    branch = dict.fromkeys(last, 2) | dict.fromkeys(first, 1) | dict.fromkeys(set(first) & set(last), 0)

    order, parents = tree.walk()
    n = len(order)
    parent, key, depth = [-1] * n, [ROOT] * n, [0] * n
    size, children, convs, leaves, saved = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    smallest: list[int] = [0] * n
    for node, above in zip(order, parents, strict=True):
        parent[node] = above
        if above >= 0:
            key[node] = blake2b(key[above] + spelled[tree.number[node]], digest_size=DIGEST).digest()
            depth[node] = depth[above] + 1
            size[node] = size_of[tree.number[node]]
        if tree.ends[node] >= 0:
            own = members[tree.ends[node]]
            convs[node], smallest[node] = len(own), own[0]
    for node in reversed(order):  # every node behind all below it
        inner = node not in branch
        if inner and not children[node]:
            leaves[node] = 1
        saved[node] += (convs[node] - inner) * size[node]
        above = parent[node]
        if above >= 0:
            smallest[above] = min(smallest[above], smallest[node]) if convs[above] else smallest[node]
            convs[above] += convs[node]
            leaves[above] += leaves[node]
            saved[above] += saved[node]
            children[above] += 1 if inner else 0

    rows: list[tuple] = []
    for node in order:
        above, ends = parent[node], members[tree.ends[node]] if tree.ends[node] >= 0 else []
        at_edge = node in branch
        outside = above < 0 or above in branch
        rows.append((
            BOUNDARY if at_edge else INNER, key[node], key[above] if above >= 0 and outside else None, smallest[node],
            depth[node], None if outside else smallest[above], convs[node], children[node], leaves[node], saved[node],
            None if at_edge else sha256(",".join(map(str, ends)).encode()).hexdigest(),
            run, branch.get(node), size[node], None,
        ))
        if at_edge:
            for i in range(0, len(ends), PIECE_IDS):
                piece = ",".join(map(str, ends[i : i + PIECE_IDS])).encode()
                rows.append((PIECE, key[node], None, ends[i], *[None] * 10, piece))
        if len(rows) >= 20_000:
            yield rows
            rows = []
    yield rows


def _shards(found: DataFrame) -> DataFrame:
    """The rows of all runs."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    flat = found.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    shards = flat.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        run = TaskContext.get().partitionId() << 32
        ids, paths, sizes, turns = [], [], [], 0
        for batch in batches:
            for conv, path, own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if ids and turns >= RUN_TURNS:
                    for rows in trie_rows(paths, ids, sizes, run):
                        yield lists(rows, _NAMES)
                    run, ids, paths, sizes, turns = run + 1, [], [], [], 0
                ids.append(conv)
                # copies of the last path share its bytes
                again = bool(paths) and path == paths[-1]
                paths.append(paths[-1] if again else path)
                sizes.append(sizes[-1] if again else own)
                turns += 1 if again else 1 + len(own)
        if ids:
            for rows in trie_rows(paths, ids, sizes, run):
                yield lists(rows, _NAMES)

    return map_columns(shards, _ROW, worker)


def _ends(pieces: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of boundary nodes in which conversations end."""
    ordered = pieces.select("node", "conv_id", "ids").repartition("node").sortWithinPartitions("node", "conv_id")

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        here, state = None, sha256()
        for batch in batches:
            done = []
            for node, _, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if node != here:
                    if here is not None:
                        done.append((here, state.hexdigest()))
                    here, state = node, sha256(ids)
                else:
                    state.update(b"," + ids)
            yield lists(done, ["node", "ends_sha256"])
        if here is not None:
            yield lists([(here, state.hexdigest())], ["node", "ends_sha256"])

    return map_columns(ordered, "node binary, ends_sha256 string", worker)


def _merged(rows: DataFrame) -> DataFrame:
    """Boundary nodes, each whole."""
    edges = rows.where(F.col("kind") == BOUNDARY)
    total = edges.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.first("size").alias("size"),
        F.min("run").alias("owner"),
    )
    below = total.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    total = total.join(below, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    # what each boundary node adds once, brought up along the paths of the run that owns it
    once = total.select("node", "owner", "size", (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    on_paths = edges.select("node", "run", "branch", "depth").join(once, "node")

    def own(column: str) -> Column:
        value = F.when(F.col("owner") == F.col("run"), F.col(column)).otherwise(F.lit(0).cast("bigint"))
        from_below = Window.partitionBy("run", "branch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
        branches = F.sum(F.when(F.col("branch") > 0, value)).over(Window.partitionBy("run"))
        shared = F.when(F.col("branch") == 0, F.coalesce(branches, F.lit(0))).otherwise(0)
        return F.sum(value).over(from_below) + shared

    raised = on_paths.select("node", own("leaf").alias("leaf"), own("size").alias("size"))
    raised = raised.groupBy("node").agg(F.sum("leaf").alias("leaf_sum"), F.sum("size").alias("size_sum"))
    whole = total.join(raised, "node").join(_ends(rows.where(F.col("kind") == PIECE)), "node", "left")
    return whole.select(
        "node",
        "parent",
        "conv_id",
        "depth",
        "n_convs",
        "n_children",
        (F.col("n_leaves") + F.col("leaf_sum")).alias("n_leaves"),
        (F.col("saved_tokens") - F.col("size_sum")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(found: DataFrame) -> DataFrame:
    """``node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``
    of every node of the trie over :func:`sequences`; ``node`` is the digest of the prefix.

    ``saved_tokens`` counts bytes, the measure that needs no tokenizer.
    """
    rows, _ = staged(_shards(found), "trie")
    boundary, _ = staged(_merged(rows), "trie-boundary")
    parents = boundary.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = rows.where(F.col("kind") == INNER)
    # the root has very many children: its row is copied and they are dealt out among the copies
    salted = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hung = inner.where("parent IS NOT NULL").drop("parent_conv_id").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    hung = hung.join(salted, ["parent", "salt"])
    return (
        inner.where("parent IS NULL")
        .select(out)
        .union(hung.select(out))
        .union(boundary.join(parents, "parent", "left").select(out))
    )
