"""The prefix trie against tries built from plain dictionaries."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from reelhouse.llm import prefix_trie as pt

TURNS = "conv_id long, turn long, role string, text string"


def _conversations(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(own, key=lambda t: t[:2])] for c, own in out.items()}


def _rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        out[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:]
    return out


def _trie(conversations):
    members = defaultdict(list)
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, below = defaultdict(int), defaultdict(lambda: [0, 0])
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            below[node[:d]][0] += node not in children
            below[node[:d]][1] += (len(own) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (own[0], len(node), members[node[:-1]][0] if node else None, len(own), children.get(node, 0), *below[node],
         sha256(",".join(str(c) for c in own if len(conversations[c]) == len(node)).encode()).hexdigest())
        for node, own in members.items())


def _rows(seed, ids):
    rng = random.Random(seed)
    rows = []
    for c in ids:
        for turn in range(rng.choice([0, 1, 2, 3, 6, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a", "bé", "same", "x" * 300])))
    return rows


@pytest.mark.parametrize("shard, turns", [(4096, 1 << 17), (3, 1 << 17), (4096, 5)])
def test_nodes_equal_those_of_dictionaries(spark, monkeypatch, shard, turns):
    monkeypatch.setattr(pt, "SHARD_CONVERSATIONS", shard)
    monkeypatch.setattr(pt, "SHARD_TURNS", turns)
    ids = [*range(0, 250), *range(-130, -80), 10**12, 10**12 + 1, 905, 17_000]
    frame = spark.createDataFrame(_rows(1, ids), TURNS).repartition(5)
    own = _conversations(map(tuple, frame.collect()))
    for rebuild, expected in ((pt.rebuilt, _trie(_rebuilt(own))), (None, _trie(own))):
        found = pt.prefix_trie(frame, rebuild=rebuild)
        assert sorted(map(tuple, found.collect())) == expected


def test_hot_prefixes_and_long_conversations(spark):
    """One opening shared by all, the same conversation many times, very many openings, one conversation of thousands of turns."""
    rows = [(c, t, "user", text) for c in range(3000) for t, text in enumerate(["hello", "hello", "bye"][:1 + c % 3])]
    rows += [(c, 0, "user", f"own {c}") for c in range(3000, 6000)] + [(6000 + c, t, "user", "again") for c in (0, 1) for t in range(3000)]
    found = pt.prefix_trie(spark.createDataFrame(rows, TURNS))
    got = {(r.conv_id, r.depth): r for r in found.collect()}
    assert len(got) == 1 + 3 + 3000 + 3000
    root = got[0, 0]
    assert (root.n_convs, root.n_children, root.n_leaves, root.parent_conv_id) == (6002, 3002, 3002, None)
    assert root.saved_tokens == 5 * 2999 + 5 * 1999 + 3 * 999 + 5 * 3000
    assert got[0, 1].ends_sha256 == sha256(",".join(str(c) for c in range(0, 3000, 3)).encode()).hexdigest()
    assert got[6000, 3000].n_convs == 2 and got[6000, 1].saved_tokens == 15_000 and got[6000, 1].n_leaves == 1


def test_hostile_rows(spark):
    rows = [(None, 1, "user", "lost"), (7, None, None, None), (7, None, None, None), (7, 2, "user", "a"), (7, 2, "user", "a"), (8, -1, "u", "sera"), (9, 1, "us", "era"), (9, 1, "us", "era")]
    frame = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("clash")).withColumn("base", F.lit(1)).withColumn("key", F.lit("k")).withColumn("path", F.lit(0))
    for rebuild, change in ((None, dict), (pt.rebuilt, _rebuilt)):
        assert sorted(map(tuple, pt.prefix_trie(frame, rebuild=rebuild).collect())) == _trie(change(_conversations(rows)))
    assert pt.prefix_trie(frame.limit(0)).count() == 0
