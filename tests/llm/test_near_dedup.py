"""Near duplicates against all pairs."""

import itertools
import random
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import near_dedup as nd


def _words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n)]


def _near(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = words[at] + "zz" + str(rng.randrange(1000))
    return words


def _corpus(seed=1):
    rng = random.Random(seed)
    rows, base = [], [_words(rng, rng.randrange(30, 200)) for _ in range(60)]
    for b in base:
        rows.append(" ".join(b))
        for _ in range(rng.randrange(0, 5)):
            rows.append(" ".join(_near(rng, b, rng.randrange(0, 5))))
    hub = _words(rng, 150)
    rows += [" ".join(_near(rng, hub, rng.randrange(1, 6))) for _ in range(300)]
    passage = _words(rng, 60)
    rows += [" ".join(_words(rng, 60) + passage + _words(rng, 40)) for _ in range(150)]
    rows += [" ".join(hub)] * 100 + [" ".join(hub).upper() + " ", "", None, "  ", "one", "One", "two words", "a b c d", "a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def _expected(docs, rows):
    """Classes by comparing every text with every other."""
    idf = nd.idf_weights(nd.document_frequencies(docs))
    texts = {}
    for i, text in rows:
        texts.setdefault(nd.text_key(text), []).append(i)
    by_id = dict(rows)
    first = [min(ids) for ids in texts.values()]
    weighted = {i: nd._weighted(by_id[i], idf) for i in first}
    top = {i: i for i in first}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(first, 2):
        if len(weighted[a][0]) and len(weighted[b][0]) and nd.similarity(weighted[a], weighted[b]) >= nd.SIMILAR - 1e-9:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {i: find(min(ids)) for ids in texts.values() for i in ids}


@pytest.mark.parametrize("block", [nd.BLOCK, 16])
def test_classes_match_all_pairs(documents, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = _corpus()
    docs = documents(rows)
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs).collect()}
    assert got == _expected(docs, rows)


def test_blocks_find_the_pairs_that_comparing_finds():
    rng = random.Random(4)
    base = _words(rng, 80) * 2
    idf = np.random.default_rng(1).uniform(1, 1.25, nd.DF_BUCKETS)
    found = [nd._weighted(" ".join(_near(rng, base, rng.randrange(0, 12))), idf) for _ in range(40)]
    expected = [(i, j) for i, j in itertools.combinations(range(40), 2) if nd.similarity(found[i], found[j]) >= nd.SIMILAR - 1e-9]
    assert nd._similar_pairs(found) == expected and 10 < len(expected) < 780


def test_samples_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(5)
    agree, exact = [], []
    for trial in range(30):
        shared = rng.integers(0, 2**63, 400).astype(np.uint64)
        own = [rng.integers(0, 2**63, 100).astype(np.uint64) for _ in range(2)]
        sides = []
        for o in own:
            f = np.sort(np.concatenate([shared, o]))
            sides.append((f, np.where(f % np.uint64(3) == 0, 2.0, 1.0)))
        exact.append(nd.similarity(sides[0], sides[1]))
        keys = [nd.band_keys(*s) for s in sides]
        agree.append(np.mean([a == b for a, b in zip(*keys)]))
    assert 0.6 < np.mean(exact) < 0.72 or exact[0] == 0.0
    assert abs(np.mean(agree) - 0.667 ** nd.ROWS) < 0.06


def test_rare_shingles_weigh_more():
    shares = np.array([1.0, 0.1, 0.001, 0.0])
    weights = nd.idf_weights(shares)
    assert weights[0] == 1 and (np.diff(weights) >= 0).all() and weights[-1] == 1 + nd.IDF_GAIN


def test_hostile_rows(documents, rows):
    long = " ".join(f"w{i}" for i in range(300_000))
    docs = documents([(None, "a b c d e f"), (1, None), (2, ""), (3, long), (4, long + " end"), (5, "same id"), (5, "other text"), (6, "same id"), (5, "same id")])
    docs = docs.withColumn("class", F.lit("x")).withColumn("node", F.lit(1)).withColumn("key", F.lit("k"))
    got = rows(nd.near_duplicates(docs), "doc_id", "class_id", "kept")
    assert got == [(None, None, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 3, False), (5, 5, True), (5, 5, True), (5, 5, True), (6, 5, False)]
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns and [r[0] for r in rows(kept, "doc_id")] == [None, 1, 3, 5, 5, 5]
    assert nd.near_duplicates(documents([])).count() == 0 and nd.one_of_each(documents([])).count() == 0


def test_no_text_is_lost_where_ids_repeat(documents, rows):
    """5 is the id of a near copy of 3 and of a text of its own, which 7 copies."""
    x = [f"x{i}" for i in range(100)]
    y = " ".join(f"y{i}" for i in range(60))
    docs = documents([(3, " ".join(x)), (5, " ".join([*x, "more"])), (5, y), (7, y), (8, y + " end"), (9, y.upper()), (9, y + "  ")])
    got = rows(nd.near_duplicates(docs), "doc_id", "class_id", "kept")
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (7, 5, False), (8, 5, False), (9, 5, False), (9, 5, False)]
    assert rows(nd.one_of_each(docs), "doc_id", "text") == [(3, " ".join(x)), (5, y)]
    extra = docs.withColumns({"h": F.lit("c"), "_h": F.lit("d"), "_gone_id": F.lit(0), "first": F.lit(1), "lead": F.lit(2)})
    assert nd.one_of_each(extra).columns == extra.columns and nd.one_of_each(extra).count() == 2


def test_components(spark, rows):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (5001, 5000)]
    rng.shuffle(links)
    got = dict(rows(nd.components(spark.createDataFrame(links, "a long, b long"))))
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300)) and got[5001] == 5000
    assert nd.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_compute_links_once_and_write_few_files(spark):
    """Rounds over few links go to as many files as there are cores, however many shuffle partitions there are."""
    from reelhouse.sources.tables import shared_folder

    shared = Path(shared_folder(spark).removeprefix("file:"))
    before, computed = set(shared.glob("*")), spark.sparkContext.accumulator(0)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in settings}

    def seen(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        links = spark.range(3000).selectExpr("id AS a", "id + 3000 AS b").mapInArrow(seen, "a long, b long")
        got = nd.components(links)
        assert got.count() == 6000 and got.where("class <> node % 3000").count() == 0
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert computed.value == 3000
    written = [len(list(p.glob("part-*"))) for p in set(shared.glob("classes-*")) - before]
    assert len(written) >= 2 and max(written) <= spark.sparkContext.defaultParallelism


def test_draws_of_a_weight_take_four_bytes_each():
    found = np.arange(1, 41, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    nd.band_keys(found, np.ones(40))
    tracemalloc.start()
    nd.band_keys(found, np.exp(np.arange(101, 141) / nd.STEP))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 40 * nd.DRAWS * 4 * 1.2


def _plain_keys(found, weights):
    """``band_keys`` feature by feature, sample by sample."""
    d, lows, ts = nd._draws(), [], []
    steps = np.round(np.log(weights) * nd.STEP)
    for k in range(nd.BANDS * nd.ROWS):
        draw = (found * nd._SPREAD[nd.WORDS + k]) >> np.uint64(48)
        t = np.floor(steps / nd.STEP / d.r[draw] + d.beta[draw])
        low = int((d.log_c[draw] - d.r[draw] * (t - d.beta[draw]) - d.r[draw]).astype(np.float32).argmin())
        lows.append(found[low])
        ts.append(int(t[low]))
    mixed, keys = nd._mix(np.array(lows) + np.array(ts).astype(np.uint64) * np.uint64(nd._P)), []
    for b in range(nd.BANDS):
        key = np.array([b], np.uint64)
        for r in range(nd.ROWS):
            key = nd._mix(key * nd._SPREAD[r % nd.WORDS] + mixed[b * nd.ROWS + r])
        keys.append(int(key.view(np.int64)[0]))
    return keys


@pytest.mark.parametrize("n", [1, 3, 400, nd.FEATURES_AT_ONCE + 100])
def test_all_samples_of_a_text_are_taken_together(n):
    """The samples are those of the plain definition, whatever weights came before, and no call is made for each of them."""
    rng = np.random.default_rng(n)
    found = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
    for weights in (np.ones(n), rng.choice([1.0, 1.22, 2.4, 40.0, 0.3], n), rng.choice([1.1, 1.6, 700.0], n)):
        assert nd.band_keys(found, weights) == _plain_keys(found, weights)
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "call" else None)
    try:
        nd.band_keys(found, weights)
    finally:
        sys.setprofile(None)
    assert len(calls) < nd.BANDS * nd.ROWS


def test_sketches_of_many_texts_are_those_of_each(documents, monkeypatch):
    monkeypatch.setattr(nd, "SKETCHES_AT_ONCE", 7)
    rows = _corpus()[:60] + [(1000, None), (1001, " "), (1002, "x")]
    docs = documents(rows).coalesce(1)
    idf = nd.idf_weights(nd.document_frequencies(docs))
    got = {r.doc_id: (bytes(r.key), r.bands) for r in nd.sketches(docs, docs.sparkSession.sparkContext.broadcast(idf)).collect()}
    assert got == {i: (nd.text_key(t), nd.band_keys(*nd._weighted(t, idf))) for i, t in rows}


def test_words_of_a_key_part_at_ascii_white_space_only():
    assert nd.text_key(" A\x0b\x0cb\r\n\tc\ud800 ") == nd.text_key("a b c\ud800") and nd.text_key(None) == nd.text_key(" \n")
    assert len({nd.text_key(f"a{c}b") for c in ("", " ", "\x1c", "\x1f", "\x85", "\xa0", "\u2003")}) == 7
