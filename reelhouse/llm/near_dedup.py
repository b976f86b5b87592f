"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles, verified by weighted Jaccard similarity.

A text is the multiset of its five-word shingles. A shingle weighs its count times 1 + IDF_GAIN * idf, idf running from 0
(in every document) to 1 (in less than one of RARE documents): damped, so that the copies of one text,
which make their shingles frequent themselves, stay similar. Texts of fewer words are one shingle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from reelhouse.llm.common import own_name, ship, stored, stored_light
from reelhouse.operators.skew import spread_join

WORDS, SIMILAR = 5, 0.8
# At a similarity of 0.8 a pair shares one of the bands with a chance of 0.9997, at 0.5 of 0.47, at 0.3 of 0.05.
BANDS, ROWS = 20, 5
# Document frequencies are counted over all documents in so many buckets of shingle hashes. Rare shingles share a bucket, so
# a bucket's share of the documents doesn't fall below (shingles a document) / DF_BUCKETS, at any size of corpus.
DF_BUCKETS, RARE, IDF_GAIN = 1 << 18, 1000.0, 0.25
# Sampling draws r, c and beta from a table by a hash of shingle and sample; weights enter it in steps of 1/8 of their logarithm.
DRAWS, STEP = 1 << 16, 8
FEATURES_AT_ONCE, BYTES_AT_ONCE, SKETCHES_AT_ONCE = 4096, 1 << 20, 256
# A text that more rows repeat than this share is dealt out when rows meet their class; there are fewer than 1 / share of them.
HOT_SHARE = 1e-3
BLOCK = 128  # texts of a bucket compared with each other in one task

_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)
_SPREAD = np.random.default_rng(1).integers(1, 1 << 63, (WORDS + BANDS * ROWS), np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ x >> np.uint64(32)


@cache
def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, base, np.uint64), dtype=np.uint64)])


def _word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of the stretch: differences of one running sum, shifted to the word's start."""
    data = np.frombuffer(raw, np.uint8)
    gap = (data == 32) | (data - np.uint8(9) < 5)
    edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    size = 1 << max(int(len(data)).bit_length(), 12)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_P, size)[:len(data)], dtype=np.uint64)])
    return _mix((total[end] - total[start]) * _powers(_P_INVERSE, size)[start])


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of the lower-case text, ascending, and their counts. A long text is read in stretches cut at white space."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    words, at = [], 0
    while at < len(raw):
        cut = re.compile(rb"[\x20\x09-\x0d]").search(raw, at + BYTES_AT_ONCE)
        words.append(_word_hashes(raw[at:cut.start() if cut else len(raw)]))
        at = cut.end() if cut else len(raw)
    w = np.concatenate(words) if words else np.zeros(0, np.uint64)
    n = min(len(w), WORDS)
    if not n:
        return w, np.zeros(0, np.int64)
    found = sum((w[k:len(w) - n + 1 + k] * _SPREAD[k] for k in range(n)), np.zeros(len(w) - n + 1, np.uint64))
    return np.unique(_mix(found + np.uint64(n)), return_counts=True)


def text_key(text: str | None) -> bytes:
    """128-bit hash of the words: equal for texts that differ only in case and white space."""
    return hashlib.blake2b(b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split()), digest_size=16).digest()


def bucket_of(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(40)).astype(np.int64) % DF_BUCKETS


def document_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Share of the documents with a shingle of each bucket, counted over all documents; DF_BUCKETS numbers come to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DF_BUCKETS + 1, np.int64)
        for batch in batches:
            for own in batch.column(0):
                total[bucket_of(shingles(own.as_py())[0])] += 1
            total[-1] += batch.num_rows
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    ship(docs.sparkSession)
    counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(DF_BUCKETS + 1)
    total[counts["bucket"].to_numpy(np.int64)] = counts["n"]
    return total[:-1] / max(total[-1], 1)


def idf_weights(shares: np.ndarray, gain: float = IDF_GAIN) -> np.ndarray:
    return 1 + gain * np.log(1 / np.clip(shares, 1 / RARE, 1)) / np.log(RARE)


class Draws(NamedTuple):
    r: np.ndarray
    beta: np.ndarray
    log_c: np.ndarray


@cache
def _draws() -> Draws:
    rng = np.random.default_rng(2)
    return Draws(rng.gamma(2, 1, DRAWS), rng.random(DRAWS), np.log(rng.gamma(2, 1, DRAWS)))


def _t(step: int | np.ndarray, draw: np.ndarray | slice = slice(None)) -> np.ndarray:
    """For a weight of exp(step / STEP): t of the draws."""
    d = _draws()
    return np.floor(step / STEP / d.r[draw] + d.beta[draw])


# Steps met so far in this process, ascending, and ln a of every draw for each of them: a text of several weights takes from one array.
_steps, _log_a = np.zeros(0, np.int64), np.zeros((0, DRAWS), np.float32)


def _places(steps: np.ndarray) -> np.ndarray:
    """The rows of ``_log_a`` for weights of exp(step / STEP); steps not met before get theirs."""
    global _steps, _log_a
    place = np.searchsorted(_steps, steps)
    if len(_steps) and (_steps.take(place, mode="clip") == steps).all():
        return place
    d, new = _draws(), np.setdiff1d(steps, _steps)
    more = np.empty((len(_steps) + len(new), DRAWS), np.float32)
    known = np.union1d(_steps, new)
    more[np.searchsorted(known, _steps)] = _log_a
    for s in new.tolist():
        more[np.searchsorted(known, s)] = d.log_c - d.r * (_t(s) - d.beta) - d.r
    _steps, _log_a = known, more
    return np.searchsorted(_steps, steps)


@cache
def _room() -> tuple[np.ndarray, np.ndarray]:
    """Memory for the draws and the ln a of one stretch of shingles, used again for every text."""
    return np.empty(BANDS * ROWS * FEATURES_AT_ONCE, np.uint64), np.empty(BANDS * ROWS * FEATURES_AT_ONCE, np.float32)


def _samples(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A number for each sample: its shingle and t of the smallest ln a."""
    n, every = BANDS * ROWS, np.arange(BANDS * ROWS)
    steps = np.round(np.log(weights) * STEP).astype(np.int64)
    at = _places(steps) * DRAWS
    best, kept, at_t = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for begin in range(0, len(found), FEATURES_AT_ONCE):
        own, step, first = (x[begin:begin + FEATURES_AT_ONCE] for x in (found, steps, at))
        # A sample's draws lie side by side, so that its smallest is found reading in order.
        draw, log_a = (room[:n * len(own)].reshape(n, len(own)) for room in _room())
        np.multiply(_SPREAD[WORDS:, None], own, out=draw)
        np.right_shift(draw, np.uint64(48), out=draw)
        place = draw.view(np.int64)
        place += first
        _log_a.ravel().take(place, out=log_a, mode="clip")
        row = log_a.argmin(1)
        value, drawn = log_a[every, row], place[every, row] - first[row]
        less = value < best
        best[less], kept[less], at_t[less] = value[less], own[row][less], _t(step[row], drawn)[less]
    return kept + at_t.astype(np.uint64) * np.uint64(_P)


def _hashed_bands(samples: np.ndarray) -> np.ndarray:
    """A hash of each band of each row of samples."""
    mixed = _mix(samples).reshape(-1, BANDS, ROWS)
    keys = np.arange(BANDS).astype(np.uint64)
    for r in range(ROWS):
        keys = _mix(keys * _SPREAD[r % WORDS] + mixed[:, :, r])
    return keys.view(np.int64)


def band_keys(found: np.ndarray, weights: np.ndarray) -> list[int]:
    """A hash of each band's samples (shingle and t of the smallest ln a); none for a text without words."""
    return _hashed_bands(_samples(found, weights))[0].tolist() if len(found) else []


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of (shingles, weights, idf): sum of the smaller weights over sum of the larger."""
    small, large = sorted((a[1].sum(), b[1].sum()))
    if small < SIMILAR * large * (1 - 1e-9):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (small + large - both)) if large else 1.0


def _weighted(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, counts = shingles(text)
    return found, counts * idf[bucket_of(found)]


def sketches(docs: DataFrame, idf: Broadcast, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h, key, bands), one row per row with an id; ``doc_id`` and ``h``, a hash of the text as it stands, tell texts apart."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, samples, ends = [], [], [0]
            for own in batch.column(2):
                own = own.as_py()
                keys.append(text_key(own))
                found, weights = _weighted(own, idf.value)
                if len(found):
                    samples.append(_samples(found, weights))
                ends.append(len(samples) * BANDS)
            flat = [_hashed_bands(np.stack(samples[k:k + SKETCHES_AT_ONCE])).ravel() for k in range(0, len(samples), SKETCHES_AT_ONCE)]
            bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *flat])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), bands], ["doc_id", "h", "key", "bands"])

    return _identified(docs, doc_id, text).mapInArrow(sketch, "doc_id long, h long, key binary, bands array<long>")


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, h, text) of the rows with an id."""
    own = F.col(text).cast("string")
    return docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(own).alias("h"), own.alias("text"))


def components(links: DataFrame, about: int | None = None) -> DataFrame:
    """(node, class): the smallest node each node of ``links`` (a, b) is connected to. Nodes are of any type with an order.

    ``links`` is computed once. ``about`` how many there may be at most sets the number of files they are first written to.

    Every round a node takes the smallest class among its neighbours' and then that class's own class, so
    paths shorten fast; each round is stored, and only two sums over hashes of the classes come to the driver.
    """
    ways = F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in (("a", "b"), ("b", "a"))])
    both = links.select(F.explode(ways).alias("way")).select("way.*").distinct()
    edges = stored(both, "links") if about is None else stored_light(both, "links", 2 * about)
    most = edges.count()
    labels = stored_light(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("class")), "classes", most)
    state = [F.sum(F.xxhash64("class").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("node", "class"))]
    before = None
    while (now := labels.agg(*state).head()) != before:
        before = now
        near = edges.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("class").alias("m"))
        lower = labels.join(near, F.col("node") == F.col("u")).select("node", F.least("class", "m").alias("class"))
        above = labels.select(F.col("node").alias("up"), F.col("class").alias("top"))
        higher = lower.join(above, F.col("class") == F.col("up"), "left").select("node", F.least("class", F.coalesce("top", "class")).alias("class"))
        labels = stored_light(higher, "classes", most)
    return labels


def _verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast) -> DataFrame:
    """The pairs (a, b) whose texts are similar. Pairs of one a follow each other, so its text is read once."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            a, b, left, right = (batch.column(i) for i in range(4))
            keep = []
            for i in range(batch.num_rows):
                text = left[i].as_py()
                if last[0] != text:
                    last = text, _weighted(text, idf.value)
                if similarity(last[1], _weighted(right[i].as_py(), idf.value)) >= SIMILAR - 1e-9:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([a.take(pa.array(keep, pa.int64())), b.take(pa.array(keep, pa.int64()))], ["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").sortWithinPartitions("a")
    return joined.mapInArrow(check, "a binary, b binary")


def _blocks(members: DataFrame, texts: DataFrame, idf: Broadcast) -> DataFrame:
    """Links (a, b) between texts of one bucket that are not yet in one class, all its texts being compared.

    A bucket is dealt out in chunks of about BLOCK texts and every chunk meets every other in a task of its own, in which
    similarities are matrix products. Links that only repeat a connection found in the task are left out.
    """
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    meets = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "class", "part")
    rows = meets.join(texts, "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        nodes, classes = group["node"].to_numpy(), group["class"].to_numpy()
        if (classes == classes[0]).all():
            return pd.DataFrame({"a": [], "b": []}, dtype=object)
        alike = _similar_pairs([_weighted(t, idf.value) for t in group["text"]])
        top = {c: c for c in classes}

        def find(c: int) -> int:
            while top[c] != c:
                top[c] = c = top[top[c]]
            return c

        links = []
        for x, y in alike:
            p, q = find(classes[x]), find(classes[y])
            if p != q:
                top[max(p, q)] = min(p, q)
                links.append((nodes[x], nodes[y]))
        return pd.DataFrame(links, columns=["a", "b"], dtype=object)

    return rows.groupBy("bucket", "i", "j").applyInPandas(compare, "a binary, b binary")


def _similar_pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Places of the similar pairs. min(x, y) summed over thresholds of the weights is a product of presences,
    so every shingle counts once per different weight it has, with the step to that weight."""
    doc = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
    shingle, weight = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    _, place, often = np.unique(shingle, return_inverse=True, return_counts=True)
    shared = often[place] > 1
    both, totals = np.zeros((len(found), len(found))), np.array([f[1].sum() for f in found])
    doc, place, weight = doc[shared], place[shared], weight[shared]
    order = np.lexsort((weight, place))
    doc, place, weight = doc[order], place[order], weight[order]
    begin = np.flatnonzero(np.diff(place, prepend=-1))
    for lo in range(0, len(begin), 2048):
        first, last = begin[lo], begin[lo + 2048] if lo + 2048 < len(begin) else len(place)
        d, w = doc[first:last], weight[first:last]
        column = np.cumsum(np.diff(place[first:last], prepend=-1) != 0) - 1
        x = np.zeros((len(found), column[-1] + 1))
        x[d, column] = w
        while (left := x > 0).any():
            step = np.where(left, x, np.inf).min(0)
            step[~np.isfinite(step)] = 0
            some = left.sum(0) > 1
            y = left[:, some].astype(float)
            both += (y * step[some]) @ y.T
            x = np.maximum(x - step, 0)[:, some]
            x[x < 1e-9] = 0
    union = totals[:, None] + totals - both
    alike = np.divide(both, union, out=np.ones_like(both), where=union > 0) >= SIMILAR - 1e-9
    return [(int(i), int(j)) for i, j in np.argwhere(np.triu(alike, 1))]


def _classes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, h, class_id, kept), one row per row with an id. A node is a text, known by its key, whatever ids its rows have."""
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(idf_weights(document_frequencies(docs, text)))
    sketch = stored(sketches(docs, idf, doc_id, text), "sketches")
    n_rows = sketch.count()
    different = stored_light(sketch.groupBy(F.col("key").alias("node")).agg(
        F.min(F.struct("doc_id", "h")).alias("first"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("rows")), "texts", n_rows)
    rows = different.select("node", "first", F.explode("bands").alias("bucket"))
    # A text with the smallest id is the likeliest to be what others were copied from, and so to be like most of its bucket.
    buckets = rows.groupBy("bucket").agg(F.min_by("node", "first").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored_light(rows.drop("first").join(buckets, "bucket"), "buckets", BANDS * n_rows)
    n_members = members.count()
    # Texts are joined by merging at every size, so that what a small input shuffles tells what a large one will.
    wanted = different.join(members.select("node").distinct(), "node", "left_semi").select("node", "first.*").hint("merge")
    texts = stored(_identified(docs, doc_id, text).join(wanted, ["doc_id", "h"]).select("node", "text"), "candidates").hint("merge")

    links = _verified(members.where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), texts, idf)
    found = components(links, n_members)
    placed = members.where("n > 2").join(found, "node", "left").withColumn("class", F.coalesce("class", "node"))
    open_sets = placed.groupBy("bucket").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.hash("node")).alias("y"), F.count(F.lit(1)).alias("n"),
    ).where("low < high").groupBy("x", "y", "n").agg(F.min("bucket").alias("bucket"))  # bands that hold the same texts
    open_members = stored_light(placed.join(open_sets.select("bucket"), "bucket").select("bucket", "n", "node", "class"), "open", n_members)
    more = _blocks(open_members, texts, idf)
    joined = found.where(F.col("node") != F.col("class")).select(F.col("node").alias("a"), F.col("class").alias("b"))
    last = components(joined.unionByName(more), n_members)
    classed = different.join(last, "node", "left").withColumn("class", F.coalesce("class", "node"))
    leads = classed.groupBy("class").agg(F.min("first").alias("lead"))
    by_text = stored_light(classed.join(leads, "class").select(F.col("node").alias("key"), "lead", "rows"), "text-classes", n_rows)
    most = F.lit(max(n_rows * HOT_SHARE, 1.0))
    hot = by_text.where(F.col("rows") > most).select("key", F.ceil(F.col("rows") / most).cast("int").alias("pieces"))
    own = spread_join(sketch.select("doc_id", "h", "key"), by_text.drop("rows"), ["key"], "doc_id", hot)
    return own.select("doc_id", "h", F.col("lead.doc_id").alias("class_id"), (F.struct("doc_id", "h") == F.col("lead")).alias("kept"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its class), kept (it is the class's first row).

    Classes are the connected components of the links, similarity SIMILAR or more, between documents that share a band.
    Texts of equal words are one text. In each bucket of a band all texts are compared with the one of the smallest id; buckets that then
    still hold several classes are compared within, every text with every other, in blocks of bounded size.

    Null and empty texts are equal texts. Rows that repeat a doc_id with other words are texts of their own; rows that repeat doc_id and text are
    one document, and all of them are kept or none. Rows without a doc_id are in no class: class_id null, kept true. An empty table gives no rows.
    """
    nameless = docs.where(F.col(doc_id).isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"), F.lit(True).alias("kept"))
    return _classes(docs, doc_id, text).drop("h").unionByName(nameless)


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not the first of their class, each told by its doc_id and text; rows without a doc_id stay."""
    dropped = _classes(docs, "doc_id", "text").where("NOT kept").select("doc_id", "h").distinct()
    name, gone_id, gone_h = (own_name(docs, c) for c in ("_h", "_gone_id", "_gone_h"))
    gone = dropped.withColumnsRenamed({"doc_id": gone_id, "h": gone_h})
    marked = docs.withColumn(name, F.xxhash64(F.col("text").cast("string")))
    return marked.join(gone, (F.col("doc_id").cast("long") == F.col(gone_id)) & (F.col(name) == F.col(gone_h)), "left_anti").drop(name)
