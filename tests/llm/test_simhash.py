"""SimHash links against all pairs."""

import itertools
import random

import xxhash
from pyspark.sql import functions as F

from reelhouse.llm import simhash as sh


def _plain(text, words=3):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\x0b\x0c\r":
        found = found.replace(gap, " ")
    found = [w for w in found.split(" ") if w]
    if not found:
        return 0
    shingles = [" ".join(found[i:i + words]) for i in range(max(len(found) - words + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def _classes(prints, radius):
    """{fingerprint: smallest fingerprint reached} by comparing every pair."""
    top = {p: p for p in prints}

    def find(p):
        while top[p] != p:
            p = top[p]
        return p

    for a, b in itertools.combinations(sorted(top), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {p: find(p) for p in top}


def _corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))
    texts = [None, "", " \n\t", "one", "ONE", "two words", "É é", "it's one", "a b c", "a\tb  c\n", "a b c d"]
    for _ in range(40):
        base = [word() for _ in range(rng.randrange(20, 400))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 8)):
            own = list(base)
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [" ".join([word() for _ in range(30)])] * 200
    return list(enumerate(texts, 5))


def test_masks_cover_every_pair_of_positions():
    for radius in (0, 2, 4):
        masks = sh.masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        places = range(64) if radius < 4 else range(0, 64, 5)
        for held in itertools.combinations(places, radius):
            assert any(not mask & sum(1 << k for k in held) for mask in masks)


def test_fingerprints_of_whole_texts():
    rng = random.Random(2)
    long = " ".join(rng.choice(["aa", "b", "Été", "c"]) for _ in range(200_000))
    for text in [t for _, t in _corpus()[:40]] + [long]:
        assert sh.fingerprint(None if text is None else text.encode()) == _plain(text)


def test_components_equal_those_of_all_pairs(spark, documents):
    rows = _corpus()
    found = {r.doc_id: r for r in sh.near_duplicates(documents(rows)).collect()}
    prints = {i: _plain(t) for i, t in rows}
    classes = _classes(set(prints.values()), 2)
    lowest = {}
    for i, p in sorted(prints.items()):
        lowest.setdefault(classes[p], i)
    assert len(found) == len(rows) and len(set(lowest.values())) < len(set(prints.values()))
    for i, p in prints.items():
        assert (found[i].fingerprint, found[i].component_id) == (f"{p:016x}", lowest[classes[p]])


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Fingerprints that differ in few bits fill whole buckets, compared pair by pair or through shared neighbours."""
    rng = random.Random(9)
    prints = set()
    for centre in (0, rng.getrandbits(64), (1 << 64) - 1):
        for _ in range(150):
            p = centre
            for _ in range(rng.randrange(0, 6)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    frame = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    for radius in (0, 2):
        expected = _classes(prints, radius)
        for most in (128, 2):
            monkeypatch.setattr(sh, "BUCKET_PAIRS", most)
            links = [(a % (1 << 64), b % (1 << 64)) for a, b in sh.links(frame, radius).collect()]
            assert all(a != b and (a ^ b).bit_count() <= radius for a, b in links)
            top = {p: p for p in prints}

            def find(p):
                while top[p] != p:
                    p = top[p]
                return p

            for a, b in links:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
            assert {p: find(p) for p in prints} == expected


def test_hostile_rows(spark, documents):
    rows = [(3, "x y z"), (3, "x y z"), (3, "other words here"), (None, "x y z"), (None, None), (1, ""), (None, "alone in this")]
    docs = documents(rows).withColumn("print", F.lit("clash")).withColumn("fingerprint", F.lit(1)).withColumn("component_id", F.lit(2)).withColumn("class", F.lit(0))
    found = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in sh.near_duplicates(docs).collect()), key=str)
    expected = [(i, f"{_plain(t):016x}", c) for (i, t), c in zip(rows, (3, 3, 3, 3, 1, 1, None))]
    assert found == sorted(expected, key=str)
    assert sh.near_duplicates(docs.limit(0)).count() == 0
