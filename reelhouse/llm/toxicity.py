"""Toxicity classifier that is penalised where swapping identity terms changes its score."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import pandas_udf

from reelhouse.llm.common import own_name, ship

# Bound of the training sample (labelled rows), features looked at and kept, least evidence for one, penalties.
SAMPLE = 20_000
BUCKETS = 1 << 20
FEATURES = 4096
EVIDENCE, LEAST_DOCS = 20.0, 4
RIDGE, SWAP_PENALTY, STEPS = 2e-5, 1.0, 600
GRAMS = (4, 5, 6)
REMEMBERED = 500_000
# Longer texts are scored by parts of at most about this many characters, the highest counting.
STRETCH = 8192
# One labelled row in so many gets neutral mentions of an identity group, beside the rows that hold such terms themselves.
MENTIONED = 4

# Terms that may be swapped within their group; "" stands for leaving the term out.
IDENTITY = (
    ("women", "men", "people", ""), ("woman", "man", "person", ""), ("girls", "boys", "children", ""),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", ""), ("muslims", "christians", "jews", "hindus", "atheists", ""),
    ("gay", "lesbian", "straight", "bisexual", "transgender", ""), ("black", "white", "asian", "latino", ""),
    ("immigrants", "refugees", "foreigners", "citizens", ""), ("disabled", "deaf", "blind", ""),
    ("frauen", "männer", "menschen", ""), ("muslime", "christen", "juden", ""), ("ausländer", "flüchtlinge", "bürger", ""),
    ("femmes", "hommes", "personnes", ""), ("musulmans", "chrétiens", "juifs", ""), ("immigrés", "réfugiés", "citoyens", ""),
    ("mujeres", "hombres", "personas", ""), ("musulmanes", "cristianos", "judíos", ""), ("inmigrantes", "refugiados", "ciudadanos", ""),
)
NOTHING = array("i")
WORDS, SPACE = re.compile(r"[^\W\d_]+"), re.compile(r"\s")


class Model(NamedTuple):
    buckets: np.ndarray  # of the kept features, ascending
    weights: np.ndarray
    bias: float
    pairs: int = 0  # of a row and a version of it with other identity terms, whose difference was penalised


def word_features(word: str) -> list[int]:
    """Buckets of a lower-case word and of its character n-grams, ends marked."""
    marked = f"^{word}$"
    parts = {marked} | {marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


class Reader:
    """Feature places of whole texts, remembering what it found for each chunk between white space."""

    def __init__(self, kept: np.ndarray | None = None) -> None:
        self.place = None if kept is None else {int(b): i for i, b in enumerate(kept)}
        self.chunks: dict[str, array] = {}  # 4 bytes a feature; tuples of numbers would take 36

    def __call__(self, text: str | None) -> set[int]:
        chunks = set((text or "").lower().split())
        if len(self.chunks) > REMEMBERED:
            self.chunks.clear()
        for chunk in chunks.difference(self.chunks):
            found = {b for w in WORDS.findall(chunk) for b in word_features(w)}
            places = found if self.place is None else [self.place[b] for b in found if b in self.place]
            self.chunks[chunk] = array("i", places) if places else NOTHING
        return set().union(*map(self.chunks.__getitem__, chunks))


def stretches(text: str | None) -> list[str]:
    """The text in parts of STRETCH characters, each drawn out to the next white space if that comes within as many again.

    The weights of a text's different words add up, so a text of a million words would be judged by the sum of what its many rare words say by chance;
    in parts, clean texts stay clean at any length, and a passage tells however long the text around it is.
    """
    text, parts, at = text or "", [], 0
    while len(text) - at > STRETCH:
        gap = SPACE.search(text, at + STRETCH, at + 2 * STRETCH)
        end = gap.start() if gap else min(at + 2 * STRETCH, len(text))
        parts.append(text[at:end])
        at = end
    return [*parts, text[at:]]


def mentions(text: str, groups: tuple[tuple[str, ...], ...] = IDENTITY) -> list[str]:
    """The text with each term of one group, chosen by the text, after it; none for most texts, again by the text."""
    h = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    return [] if h % MENTIONED else [f"{text} {term}" for term in groups[h // MENTIONED % len(groups)] if term]


def swaps(text: str, groups: tuple[tuple[str, ...], ...] = IDENTITY) -> list[str]:
    """Versions of the text whose identity terms are exchanged: the k-th has every term replaced by the k-th next of its group."""
    turn = {t: (g, i) for g in groups for i, t in enumerate(g) if t}
    lower = text.lower()
    found = [turn[w] for w in set(WORDS.findall(lower)) if w in turn]

    def version(k: int) -> str:
        return WORDS.sub(lambda m: turn[m[0]][0][(turn[m[0]][1] + k) % len(turn[m[0]][0])] if m[0] in turn else m[0], lower)

    return [version(k) for k in range(1, max((len(g) for g, _ in found), default=1))]


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE) -> DataFrame:
    """(toxic, text) of at most ``rows`` labels, chosen by a hash of doc_id; so few that they are broadcast to the texts."""
    chosen = labels.where(learn & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")


def choose_features(rows: DataFrame) -> np.ndarray:
    """Buckets whose presence tells most about the label, by the log-likelihood ratio; FEATURES at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, n = Reader(), np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = n[int(bool(toxic))]
                own[-1] += 1
                own[list(read(text))] += 1
        used = np.flatnonzero(n.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[1, used]), pa.array(n[0, used])], ["bucket", "toxic", "clean"])

    counts = rows.mapInArrow(count, "bucket long, toxic long, clean long").groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).cache()
    all_toxic, all_clean = (counts.where(F.col("bucket") == BUCKETS).select("toxic", "clean").head() or (0, 0))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    if not all_toxic or not all_clean:
        return np.zeros(0, np.int64)
    share = (F.col("toxic") + F.col("clean")) / F.lit(float(all_toxic + all_clean))
    evidence = F.lit(2.0) * (
        part(F.col("toxic"), share * all_toxic) + part(F.col("clean"), share * all_clean)
        + part(all_toxic - F.col("toxic"), (F.lit(1.0) - share) * all_toxic) + part(all_clean - F.col("clean"), (F.lit(1.0) - share) * all_clean))
    kept = counts.where((F.col("bucket") < BUCKETS) & (F.col("toxic") + F.col("clean") >= LEAST_DOCS)) \
        .select("bucket", evidence.alias("evidence")).where(F.col("evidence") >= EVIDENCE)
    found = [r.bucket for r in kept.orderBy(F.desc("evidence"), "bucket").limit(FEATURES).collect()]
    counts.unpersist()
    return np.sort(np.array(found, np.int64))


def examples(rows: DataFrame, kept: np.ndarray, groups: tuple = IDENTITY) -> pa.Table:
    """(toxic, order, places, swapped): kept features of each row and of its counterfactual versions, swapped or with mentions. One row per sampled label."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(kept)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                pa.array([sorted(reader(t)) for t in texts], pa.list_(pa.int32())),
                pa.array([[sorted(reader(s)) for s in swaps(t, groups) or mentions(t, groups)] for t in texts], pa.list_(pa.list_(pa.int32()))),
            ], ["toxic", "order", "places", "swapped"])

    return rows.mapInArrow(read, "toxic int, order long, places array<int>, swapped array<array<int>>").toArrow()


class _Presence:
    """Features present in each row, read in stretches so that what a step computes on them stays small."""

    def __init__(self, lists: pa.ListArray, features: int) -> None:
        ends = np.asarray(lists.offsets, np.int64)
        self.column = np.asarray(lists.flatten(), np.int32)
        self.row = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(ends))
        self.rows, self.features = len(lists), features

    def _stretches(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(self.row), 1 << 18):
            yield self.row[at:at + (1 << 18)], self.column[at:at + (1 << 18)]

    def times(self, weights: np.ndarray) -> np.ndarray:
        return sum((np.bincount(r, weights[c], self.rows) for r, c in self._stretches()), np.zeros(self.rows))

    def turned_times(self, slope: np.ndarray) -> np.ndarray:
        return sum((np.bincount(c, slope[r], self.features) for r, c in self._stretches()), np.zeros(self.features))


def fit(found: pa.Table, kept: np.ndarray, swap_penalty: float = SWAP_PENALTY) -> Model:
    """Logistic regression; every difference of score between a row and its swapped version costs its square."""
    y = np.asarray(found["toxic"], float)
    if not len(y) or y.min() == y.max():
        return Model(kept[:0], np.zeros(0), 20.0 if len(y) and y.max() else -20.0)
    found = found.take(np.lexsort((found["order"].to_numpy(), y))).combine_chunks()
    y, n = np.asarray(found["toxic"], float), len(y)
    own = _Presence(_list(found["places"]), len(kept))
    swapped = _list(found["swapped"])
    origin = np.repeat(np.arange(n), np.diff(np.asarray(swapped.offsets)))
    other = _Presence(swapped.flatten(), len(kept)) if len(origin) else None
    w, moment, second = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    for step in range(1, STEPS + 1):
        z = own.times(w[:-1]) + w[-1]
        slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        gradient = np.zeros(len(w))
        if other:
            pull = 2 * swap_penalty * (z[origin] - other.times(w[:-1]) - w[-1]) / len(origin)
            slope = slope + np.bincount(origin, pull, n)
            gradient[:-1] -= other.turned_times(pull)
            gradient[-1] -= pull.sum()
        gradient[:-1] += own.turned_times(slope) + RIDGE * w[:-1]
        gradient[-1] += slope.sum()
        moment, second = 0.9 * moment + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        w -= 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8) * (1 - step / (STEPS + 1))
    return Model(kept, w[:-1], float(w[-1]), len(origin))


def _list(column: pa.ChunkedArray) -> pa.ListArray:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def learn_model(docs: DataFrame, labels: DataFrame, learn: Column, swap_penalty: float = SWAP_PENALTY) -> Model:
    """The model of the labelled rows that ``learn``, an expression over labels, is true for.

    Without rows of both labels the model gives the one label it has seen, or none toxic.
    """
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, learn)
    kept = choose_features(rows)
    return fit(examples(rows, kept), kept, swap_penalty)


def logit(text: str | None, model: Model, read: Reader) -> float:
    """The highest log-odds of the text's stretches."""
    return max(model.bias + model.weights[sorted(read(part))].sum() for part in stretches(text))


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; null and empty texts get that of a text without features."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*shared.value)
        read = Reader(own.buckets)
        for texts in batches:
            z = np.array([logit(t, own, read) for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn(score, rate(F.col(text)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that a model learned from their labels doesn't reject, columns unchanged.

    Rows that repeat a doc_id are judged each by its own text; where documents or labels repeat a doc_id, every pair of text and label
    is an example. Labels without a doc_id, or of no document, teach nothing.
    """
    score = own_name(docs, "_toxicity")
    rated = scored(docs, learn_model(docs, labels, ~held_out()), score=score)
    return rated.where(F.col(score) < 0.5).drop(score)
