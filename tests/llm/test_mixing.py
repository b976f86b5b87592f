"""Mixing: targets against the rule step by step, exact cuts, hot and odd sources."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from reelhouse.llm import mixing as mx


def _targets(sizes):
    """Deal out by weight again and again until no source is above its cap."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    full, total = {}, float(sum(sizes.values()))
    while True:
        rest = [n for n in names if n not in full]
        if not rest:
            return full
        level = (total - sum(full.values())) / sum(weight[n] for n in rest)
        over = [n for n in rest if level * weight[n] > 3 * sizes[n]]
        if not over:
            return full | {n: level * weight[n] for n in rest}
        full |= {n: 3.0 * sizes[n] for n in over}


def _docs(documents):
    rng = random.Random(5)
    found = []
    for i in range(6000):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "Z", "é", None, ""])
        found.append((i, "w " * rng.randrange(0, 30), "en", source))
    return documents(found + [(7000, "one two", "en", "tiny"), (7001, None, "en", "void"), (None, "x y z", "en", "a"), (1, "again", "en", "a"), (1, "again", "en", "a")])


def test_targets_and_exact_cuts(documents):
    got = mx.mix(_docs(documents)).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
    expected = _targets(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and (r.taken == 0 or r.copies > 0)
        taken[r.source] += r.taken
    for name, words in taken.items():
        assert 0 <= expected[name] - words < 1 + 1e-6
    assert len(got) == 6005


def test_reruns_agree(documents, rows, spark):
    once = rows(mx.mix(_docs(documents)))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(mx.mix(_docs(documents).repartition(5))) == once
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_order_is_random_within_a_source(documents):
    got = mx.mix(documents([(i, "w w", "en", "big" if i < 3000 else "small") for i in range(3300)])).collect()
    big = sorted((r.doc_id, r.taken) for r in got if r.source == "big")
    assert 0.2 < sum(t > 0 for _, t in big[:1500]) / max(1, sum(t > 0 for _, t in big)) < 0.8


def test_mixed_documents_are_whole(documents):
    docs = _docs(documents).withColumn("size", F.lit("x")).withColumn("range", F.lit(1))
    mixed, plan = mx.mixed_documents(docs), mx.mix(docs).collect()
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in plan)
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    assert {(r.doc_id, r.text) for r in mixed.collect()} <= texts


def test_empty_tables(documents):
    assert mx.mix(documents([])).count() == 0
    nothing = mx.mix(documents([(1, "", "en", "a"), (2, None, "en", "b")])).collect()
    assert [r.taken for r in nothing] == [0, 0]
