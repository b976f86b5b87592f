"""Language identification by an n-gram presence kernel with Nyström landmarks and ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.functions import pandas_udf

from reelhouse.llm.common import ship, stored

# Features, bound of the training sample (different labelled texts over all languages, and least per language), landmarks, ridge.
BUCKETS = 1 << 14
SAMPLE, SAMPLE_LEAST = 4000, 20
LANDMARKS = 256
RIDGE = 1e-2
ORDERS = (1, 2, 3, 4)
ROWS_AT_ONCE = 128
CHARS_AT_ONCE = 1 << 20
STRETCH = 1 << 14  # characters whose n-grams leave most buckets empty


class Model(NamedTuple):
    langs: list[str]
    weights: np.ndarray  # BUCKETS x languages: the landmarks' normalised presence vectors times their coefficients


@cache
def _letters() -> np.ndarray:
    """The lower-case letter of each code point, a space for all that are no letters."""
    return np.array([ord(chr(i).lower()[0]) if chr(i).isalpha() else 32 for i in range(0x110000)], np.uint32)


def grams(text: str) -> np.ndarray | None:
    """Buckets of the n-grams of all orders that occur in the text; None without a letter. Long texts go in overlapping stretches."""
    seen, letters = np.zeros(BUCKETS, bool), False
    for start in range(0, max(len(text), 1), CHARS_AT_ONCE):
        stretch = text[start:start + CHARS_AT_ONCE + max(ORDERS) - 1]
        chars = _letters()[np.frombuffer(stretch.encode("utf-32-le", "surrogatepass"), "<u4")]
        letters = letters or bool((chars != 32).any())
        padded = np.concatenate([[32], chars, [32]]).astype(np.uint32)
        hashed = np.zeros(len(padded), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(padded) < n:
                break
            hashed = hashed[:len(padded) - n + 1] * np.uint32(0x01000193) + padded[n - 1:] * np.uint32(0x9E3779B1)
            if n in ORDERS:
                mixed = (hashed ^ hashed >> np.uint32(15)) * np.uint32(0x85EBCA6B) + np.uint32(n)
                seen[(mixed ^ mixed >> np.uint32(13)) * np.uint32(0xC2B2AE35) >> np.uint32(32 - 14)] = True
    return np.flatnonzero(seen) if letters else None


def stretches(text: str) -> list[str]:
    """The whole text in stretches of about equal length, STRETCH at most but for the n-grams they share."""
    n = max(-(-len(text) // STRETCH), 1)
    return [text[len(text) * i // n:len(text) * (i + 1) // n + (max(ORDERS) - 1 if i < n - 1 else 0)] for i in range(n)]


def _rows(found: list[np.ndarray]) -> np.ndarray:
    """Presence vectors, scaled to length one."""
    x = np.zeros((len(found), BUCKETS), np.float32)
    for i, own in enumerate(found):
        x[i, own] = 1 / np.sqrt(len(own))
    return x


def sample(docs: DataFrame, learn: Column, rows: int = SAMPLE, least: int = SAMPLE_LEAST) -> pd.DataFrame:
    """(lang, packed presence bits) of different labelled texts with a letter, chosen by a hash of the text.

    A long text stands for itself by the stretch its hash tells, or the first after it with a letter. Every language gives as many, ``rows`` over their number or ``least``; all it has where it has fewer. Copies of a text count once.
    """
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("hash"))
    different = stored(labelled.select("lang", "hash").distinct(), "different-texts")
    counts = different.groupBy("lang").count()
    total = counts.agg(F.count(F.lit(1))).scalar()
    wanted = F.greatest(F.lit(least), F.ceil(F.lit(rows) / total)).alias("wanted")
    ship(docs.sparkSession)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # of the chosen texts
        for batch in batches:
            new = []
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            part = batch.take(pa.array(new, pa.int64()))
            found = [next((f for i in range(len(own)) if (f := grams(own[(key + i) % len(own)])) is not None), None)
                     for key, own in zip(part.column(1).to_pylist(), map(stretches, part.column(2).to_pylist()), strict=True)]
            packed = [None if f is None else np.packbits(np.isin(np.arange(BUCKETS), f)).tobytes() for f in found]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], ["lang", "hash", "bits"])

    # About four times as many as wanted, so that the exact cut sorts few rows.
    place = F.pmod("hash", F.lit(1 << 30))
    near = different.join(F.broadcast(counts.select("lang", "count", wanted)), "lang").where(place / F.lit(float(1 << 30)) < 4 * F.col("wanted") / F.col("count"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(place, "hash"))
    chosen = near.withColumn("turn", turn).where(F.col("turn") <= F.col("wanted")).select("lang", "hash")
    found = labelled.join(F.broadcast(chosen), ["lang", "hash"]).select("lang", "hash", "text").mapInArrow(bits, "lang string, hash long, bits binary")
    once = found.where("bits IS NOT NULL").groupBy("lang", "hash").agg(F.min("bits").alias("bits")).select("lang", "bits").toPandas()
    return once.sort_values(["lang", "bits"], ignore_index=True)


def fit(found: pd.DataFrame, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression, one language against the rest, in the space the landmarks span."""
    langs = sorted(found["lang"].unique())
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    packed = np.stack([np.frombuffer(b, np.uint8) for b in found["bits"]])

    def presence(rows: np.ndarray) -> np.ndarray:
        return _rows([np.flatnonzero(np.unpackbits(p)) for p in rows])

    order = np.random.default_rng(0).permutation(len(packed))
    by_lang = found["lang"].to_numpy()
    turn = pd.Series(by_lang[order]).groupby(by_lang[order]).cumcount().to_numpy()  # languages take turns as landmarks
    marks = presence(packed[order[np.argsort(turn, kind="stable")][:landmarks]])
    kernel = np.concatenate([presence(packed[i:i + 256]) @ marks.T for i in range(0, len(packed), 256)]).astype(np.float64)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    x = kernel @ whiten
    y = np.where(by_lang[:, None] == np.array(langs), 1.0, -1.0)
    solved = np.linalg.solve(x.T @ x + ridge * len(x) / max(x.shape[1], 1) * np.eye(x.shape[1]), x.T @ y)
    return Model(langs, (marks.T @ (whiten @ solved)).astype(np.float32))


def predict(texts: list[str | None], model: Model) -> pd.DataFrame:
    """lang and score of each text, from the mean of its stretches with a letter; ``und`` with score 0 for null texts and texts without a letter."""
    lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
    sums, sizes = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))
    held: list[tuple[int, int, np.ndarray]] = []

    def flush() -> None:
        if held:
            place, size = np.array([h[0] for h in held]), np.array([h[1] for h in held], float)
            np.add.at(sums, place, (_rows([h[2] for h in held]) @ model.weights).astype(np.float64) * size[:, None])
            np.add.at(sizes, place, size)
            held.clear()

    for i, text in enumerate(texts):
        for own in stretches(text) if text and model.langs else ():
            if (found := grams(own)) is not None:
                held.append((i, len(own), found))
                if len(held) == ROWS_AT_ONCE:
                    flush()
    flush()
    some = np.flatnonzero(sizes)
    if len(some):
        out = sums[some] / sizes[some, None]
        share = np.exp(4 * (out - out.max(1, keepdims=True)))
        lang[some], score[some] = np.array(model.langs, object)[out.argmax(1)], share.max(1) / share.sum(1)
    return pd.DataFrame({"lang": lang, "score": score})


def identify(docs: DataFrame, learn: Column, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, learned from the rows of ``docs`` that ``learn`` is true for.

    Scoring is one matrix product per batch: presence vectors times BUCKETS x languages weights,
    which are broadcast. Without any labelled row every text is ``und``.
    """
    model = docs.sparkSession.sparkContext.broadcast(tuple(fit(sample(docs, learn))))

    @pandas_udf("lang string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield predict(list(texts), Model(*model.value))

    return docs.withColumn("_lang", score(F.col(text))).withColumns(
        {"lang_pred": F.col("_lang.lang"), "score": F.col("_lang.score")}).drop("_lang")
