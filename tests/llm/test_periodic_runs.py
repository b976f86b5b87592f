"""Runs against a search over every period, Lyndon arrays against their definition."""

import random
import zlib
from hashlib import sha256

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reelhouse.llm import periodic_runs as pr


def _runs(words, shortest=6, repeats=4):
    """Every stretch whose words repeat at a distance p, for every p that no smaller one explains."""
    n, out = len(words), []
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            own = words[i:j + p]
            if len(own) >= max(shortest, repeats * p) and not any(own[q:] == own[:-q] for q in range(1, p)):
                out.append((i, len(own), p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _looping(rng, n=60):
    words = [rng.randrange(4) for _ in range(rng.randrange(n))]
    for _ in range(rng.randrange(4)):
        root = [rng.randrange(3) for _ in range(rng.randrange(1, 8))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (root * 9)[:rng.randrange(len(root), 9 * len(root))]
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_groups_are_lyndon_words(words):
    different, dense = np.unique(np.array(words, np.int64), return_inverse=True)
    if not len(dense):
        return
    group, length = pr.lyndon_groups(dense.tolist(), len(different))
    for i, g in enumerate(group):
        j = i + 1
        while j < len(words) and words[i:] < words[j:]:
            j += 1
        assert length[g] == j - i
        assert all(words[i:j] == words[k:k + j - i] for k, other in enumerate(group) if other == g)


def test_runs_equal_those_of_every_period():
    rng, seen = random.Random(3), 0
    for _ in range(3000):
        words = _looping(rng)
        expected = _runs(words)
        assert [tuple(r) for r in pr.runs(np.array(words, np.int64))] == expected
        seen += len(expected)
        assert [tuple(r) for r in pr.runs(np.array(words, np.int64), 2, 3)] == _runs(words, 2, 3)
    assert seen > 1000


def test_long_texts():
    assert pr.runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    assert pr.runs(np.tile(np.arange(5000), 40)) == [(0, 200_000, 5000)]
    a, b = [0], [0, 1]
    while len(b) < 100_000:
        a, b = b, b + a
    assert pr.runs(np.array(b)) == []  # no Fibonacci word holds a fourth power
    assert len(pr.runs(np.array(b), 2, 3)) > 10_000


def _expected(doc_id, text):
    words = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ")
    words = [w for w in words if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = _runs(words)
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    kept = [w for i, w in enumerate(words) if i not in gone]
    longest = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    return (doc_id, len(found), *longest, sha256(listed.encode()).hexdigest(), sha256(" ".join(kept).encode()).hexdigest())


def test_rows_equal_brute_force(spark, documents):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{w}" for w in _looping(rng, 90))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "a " * 50), (903, "a " * 50), (None, "b c " * 9), (904, "é  é  " * 7), (905, "x"), (906, "a\tb\n" * 8)]
    docs = documents(rows).withColumn("n_runs", F.lit("clash")).withColumn("start", F.lit(0)).withColumn("words", F.lit(1))
    found = pr.periodic_runs(docs, loops=True)
    own = [tuple(r)[:8] for r in found.collect()]
    expected = [_expected(i, t) for i, t in rows]
    assert sorted(own, key=str) == sorted(expected, key=str)
    assert sum(r[1] > 0 for r in expected) > 100
    assert pr.periodic_runs(docs.limit(0)).count() == 0
