"""Runs of repeated word sequences, from Lyndon arrays that suffix grouping yields under both word orders.

Grouping (the first phase of Baier's suffix sorter) puts suffixes that begin with the same longest Lyndon word into one group. Groups
are finished from the largest down. When one is finished, the nearest position before each of its suffixes that lies in a smaller
group takes the group's word onto the end of its own, and so moves to a new group just above its old one; positions that took it
more often move higher. In the end a group's length is the Lyndon array's value for its members: nothing has to be sorted further.

The period of a run is the length of a Lyndon root under one of the two orders, and the roots of a run follow each other as members
of one group. Every chain of at least ``repeats - 1`` such roots is extended to both sides by longest common extensions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelhouse.llm.common import ship

SHORTEST, REPEATS = 6, 4


class Run(NamedTuple):
    start: int
    length: int
    period: int


def lyndon_groups(ranks: list[int], symbols: int) -> tuple[list[int], list[int]]:
    """Per position its final group, and per group the length of the Lyndon word its members begin with.

    ``ranks`` are 0 to ``symbols`` - 1, every one in use. Time is near linear: each position finishes once and hands its word on once.
    """
    n = len(ranks)
    group = [-1, *ranks]  # place 0 stands before the text and is in no group
    members: list[list[int]] = [[] for _ in range(symbols)]
    for place, rank in enumerate(ranks, 1):
        members[rank].append(place)
    left = [len(m) for m in members]  # members that haven't moved on
    length, below, above = [1] * symbols, list(range(-1, symbols - 1)), [*range(1, symbols), -1]
    before = list(range(-1, n))  # a place not smaller than its suffix's group; exact for finished places
    finished = bytearray(n + 1)
    current = symbols - 1
    while current >= 0:
        own = [place for place in members[current] if group[place] == current] if left[current] != len(members[current]) else members[current]
        word = length[current]
        for place in own:
            finished[place] = 1
        taken: dict[int, int] = {}
        for place in own:
            at = before[place]
            while finished[at]:
                at = before[at]
            before[place] = at
            if at:
                taken[at] = taken.get(at, 0) + 1
        if taken:
            most = max(taken.values())
            for times in range(most, 0, -1):
                moved: dict[int, int] = {}
                for place, k in taken.items():
                    if k != times:
                        continue
                    old = group[place]
                    if left[old] == 1 and old not in moved:  # alone in its group, which grows as it is
                        length[old] += times * word
                        continue
                    new = moved.get(old)
                    if new is None:
                        new = moved[old] = len(members)
                        members.append([])
                        left.append(0)
                        length.append(length[old] + times * word)
                        up = above[old]
                        below.append(old)
                        above.append(up)
                        above[old] = new
                        if up >= 0:
                            below[up] = new
                    members[new].append(place)
                    left[new] += 1
                    left[old] -= 1
                    group[place] = new
        current = below[current]
        while current >= 0 and not left[current]:
            current = below[current]
    return group[1:], length


def extension(words: np.ndarray, a: int, b: int, step: int, most: int) -> int:
    """How many of at most ``most`` words agree from places ``a`` and ``b`` on, going up (step 1) or down (-1)."""
    size, done = 16, 0
    while done < most:
        size = min(size * 2, most - done)
        if step > 0:
            differ = np.flatnonzero(words[a + done:a + done + size] != words[b + done:b + done + size])
        else:
            differ = np.flatnonzero(words[a - done - size + 1:a - done + 1][::-1] != words[b - done - size + 1:b - done + 1][::-1])
        if len(differ):
            return done + int(differ[0])
        done += size
    return most


def _runs_of(words: np.ndarray, symbols: int, shortest: int, repeats: int) -> set[Run]:
    """Runs of a text of dense word numbers."""
    n, found = len(words), set()
    for ranks in (words, symbols - 1 - words):
        groups, lengths = lyndon_groups(ranks.tolist(), symbols)
        group = np.array(groups)
        period = np.array(lengths)[group]
        place = np.arange(n)
        again = np.minimum(place + period, n - 1)
        repeated = (place + period < n) & (group[again] == group)  # its root is followed by the same root
        chained = repeated.copy()
        at = again
        for _ in range(repeats - 3):  # at least repeats - 1 whole roots lie in a run of `repeats` periods
            chained &= repeated[at]
            at = np.minimum(at + period, n - 1)
        preceded = np.zeros(n, bool)
        preceded[again[repeated]] = True
        for root in np.flatnonzero(chained & ~preceded).tolist():
            p = int(period[root])
            end = root + p + extension(words, root, root + p, 1, n - root - p)
            start = root - extension(words, root - 1, root + p - 1, -1, root)
            if end - start >= max(shortest, repeats * p):
                found.add(Run(start, end - start, p))
    return found


def runs(words: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> list[Run]:
    """All runs of a text given as word numbers, by start and period.

    A run is a stretch that no neighbouring word extends, with smallest period q and length of at least ``shortest`` and
    ``repeats`` * q. A word occurs ``repeats`` times in a run of it, so rarer words part the text into stretches
    that are grouped by themselves; runs neither hold nor touch such words as part of their period.
    """
    if repeats < 3:
        raise ValueError("chains of roots need three repeats or more")
    if len(words) < shortest:
        return []
    often = np.bincount(words)[words] >= repeats
    edge = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]).astype(np.int8)))
    found = []
    for begin, end in edge.reshape(-1, 2).tolist():
        if end - begin >= shortest:
            different, dense = np.unique(words[begin:end], return_inverse=True)
            found += [Run(start + begin, length, p) for start, length, p in _runs_of(dense, len(different), shortest, repeats)]
    return sorted(found, key=lambda r: (r.start, r.period))


def kept_words(n: int, found: list[Run]) -> np.ndarray:
    """True for the words that stay when every run is collapsed to its first period."""
    depth = np.zeros(n + 1, np.int64)
    for run in found:
        depth[run.start + run.period] += 1
        depth[run.start + run.length] -= 1
    return np.cumsum(depth[:n]) == 0


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers in order of their first occurrence."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of one document in ten from some place on replaced by a repetition of those that follow it, by a hash of ``doc_id``."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


RESULT = """doc_id long, n_runs long, start long, length long, period long, exponent_milli long,
    runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long"""


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", loops: bool = False, shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256, n_words, n_kept.

    The longest run is the one of smallest start, then period, among equals; a text without a run has four nulls there. Words are what
    ASCII white space parts, compared byte by byte. With ``loops`` the words are first changed by ``looped``.
    Null, empty and blank texts have no words. Rows are independent, so repeated rows and ids give repeated rows; a null doc_id leaves the words unchanged.
    An empty table gives no rows. Other columns of ``docs`` are not read. A text is read whole, in memory that grows with that one text.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in RESULT.split(",")]
        kinds = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
        for batch in batches:
            rows = []
            for own, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (value.as_py() or b"").split()
                if loops:
                    words = looped(words, own)
                found = runs(numbered(words), shortest, repeats)
                best = min(found, key=lambda r: (-r.length, r.start, r.period), default=None)
                stays = kept_words(len(words), found)
                collapsed = b" ".join(w for w, stay in zip(words, stays.tolist()) if stay) if found else b" ".join(words)
                listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in found)
                longest = (best.start, best.length, best.period, 1000 * best.length // best.period) if best else (None,) * 4
                rows.append((own, len(found), *longest, sha256(listed.encode()).hexdigest(), sha256(collapsed).hexdigest(), len(words), int(stays.sum())))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(read, RESULT)
