"""The trie against a dictionary of all prefixes."""

import math
import random
from hashlib import sha256
from zlib import crc32

import pytest

from chunkloom.llm import conversation_tries as ct

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_convs string"


def in_order(rows):
    """The turns of each conversation; no two of one conversation have the same number here."""
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(own)] for c, own in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[b] for b in below) or 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        saved[prefix] = own + sum(saved[b] for b in below)
    out = []
    for prefix, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(own), len(prefix), parent, len(own), len(children.get(prefix, [])), leaves[prefix], saved[prefix], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(frame):
    return sorted((tuple(r) for r in frame.select(COLUMNS).collect()), key=repr)


def conversations(rng, n):
    rows = []
    for c in range(-7, n):
        if rng.random() < 0.1:
            continue
        for turn in range(rng.choice([1, 2, 3, 8, 12])):
            text = rng.choice(["", None, "é", "hello there", "x" * 9])
            rows.append((c, None if turn == 0 and c % 3 else turn, rng.choice(["user", None, ""]), text, "clash"))
    rows += [(1000 + c, t, "user", f"copy {t}", "clash") for c in range(40) for t in range(4)]
    rows += [(2000, t, "user", f"turn {t}", "clash") for t in range(60)] + [(2001, t, "user", f"turn {t}", "c") for t in range(59)]
    rows += [(None, 0, "user", "nobody", "clash")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("run_turns", "piece"), [(200_000, 50_000), (40, 3)])
def test_trie_is_brute_force(spark, monkeypatch, run_turns, piece):
    monkeypatch.setattr(ct, "RUN_TURNS", run_turns)
    monkeypatch.setattr(ct, "PIECE_IDS", piece)
    rows = conversations(random.Random(run_turns), 150)
    sequences = ct.sequences(spark.createDataFrame(rows, SCHEMA).repartition(3))
    convs = in_order(rows)
    assert found(ct.prefix_trie(sequences)) == brute(convs)
    assert found(ct.prefix_trie(ct.rebuilt(sequences))) == brute(rebuilt(convs))


def test_no_conversations_and_turnless_ones(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert found(ct.prefix_trie(ct.rebuilt(ct.sequences(none)))) == []
    gone = next(c for c in range(1, 99) if c % 5 and crc32(str(c).encode()) % 9 > 0)  # its one turn is replaced by nothing
    rows = spark.createDataFrame([(gone, 0, "user", "x", "")], SCHEMA)
    expected = [(gone, 0, None, 1, 0, 1, 0, sha256(str(gone).encode()).hexdigest())]
    assert found(ct.prefix_trie(ct.rebuilt(ct.sequences(rows)))) == expected


def test_repeated_rows_and_equal_turns(spark):
    rows = [(1, 0, "user", "b", ""), (1, 0, "user", "a", ""), (1, 0, "user", "a", ""), (2, 0, "user", "a", ""), (2, 0, "user", "b", "")]
    rows += [(2, 0, "user", "a", "")]
    trie = ct.prefix_trie(ct.sequences(spark.createDataFrame(rows, SCHEMA)))
    # whatever their order is, it is the same for both
    assert sorted(r["n_convs"] for r in trie.collect()) == [2, 2, 2, 2]


def test_trees_are_balanced():
    tree = ct.TernaryTree()
    for i in ct.median_first(1000):
        tree.insert([i, 5], i)
    depth, level = 0, [tree.equal[0]]
    while level:
        depth += 1
        level = [c for node in level for c in (tree.low[node], tree.high[node]) if c >= 0]
    assert depth == 10
    assert sorted(ct.median_first(37)) == list(range(37))


def test_roles_and_texts_do_not_run_together(spark):
    rows = [(1, 0, "ab", "c", ""), (2, 0, "a", "bc", "")]
    assert ct.prefix_trie(ct.sequences(spark.createDataFrame(rows, SCHEMA))).count() == 3
