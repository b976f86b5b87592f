"""Byte-level BPE encoding through a rank queue, and decoding."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.llm.common import ship
from reelhouse.llm.pieces import TextCoder

ROWS_AT_ONCE = 512
MERGED_AT_ONCE = 1 << 18  # bytes in one linked list, which takes about 200 times as many
WORD, LOW = 6, 63  # a level of the bitmap has a bit for each 64-bit word of the level below


class RankQueue:
    """Merge ranks in use, as a bitmap of three levels over buckets of list positions.

    ``first`` finds the lowest rank by the lowest set bit of each level. A bucket may hold positions
    whose pair has since changed; the reader skips them.
    """

    def __init__(self, ranks: int) -> None:
        self.bits = [0] * ((ranks >> WORD) + 1)
        self.words = [0] * ((ranks >> 2 * WORD) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
        else:
            self.open(rank, [position])

    def open(self, rank: int, positions: list[int]) -> None:
        self.buckets[rank] = positions
        self.bits[rank >> WORD] |= 1 << (rank & LOW)
        self.words[rank >> 2 * WORD] |= 1 << (rank >> WORD & LOW)
        self.top |= 1 << (rank >> 2 * WORD)

    def first(self) -> int:
        i = (self.top & -self.top).bit_length() - 1
        i = i << WORD | (self.words[i] & -self.words[i]).bit_length() - 1
        return i << WORD | (self.bits[i] & -self.bits[i]).bit_length() - 1

    def pop(self, rank: int) -> list[int]:
        i, j = rank >> WORD, rank >> 2 * WORD
        self.bits[i] &= ~(1 << (rank & LOW))
        if not self.bits[i]:
            self.words[j] &= ~(1 << (i & LOW))
            if not self.words[j]:
                self.top &= ~(1 << j)
        return sorted(self.buckets.pop(rank))


class ByteBpe:
    """A vocabulary of byte strings, each token's id being its merge rank."""

    def __init__(self, file: bytes) -> None:
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines()) if token}
        self.size = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.bytes_rank = np.array([self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])
        self.pairs = {
            self.ranks[token[:i]] * self.size + self.ranks[token[i:]]: rank
            for token, rank in self.ranks.items() for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        }

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each pre-token."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        whole = [self.ranks.get(p) for p in raw]
        merged = self._merged(p for p, rank in zip(raw, whole, strict=True) if rank is None)
        return [next(merged) if rank is None else rank.to_bytes(4, "little") for rank in whole]

    def _merged(self, pieces: Iterable[bytes]) -> Iterator[bytes]:
        """Ids of the pieces, merged in lists of at least MERGED_AT_ONCE bytes, which end with a piece."""
        held, size = [], 0
        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size >= MERGED_AT_ONCE:
                yield from self._merge(held)
                held, size = [], 0
        yield from self._merge(held)

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        """Merge the pieces together: all lie in one linked list, no pair reaching over a piece's end.

        The lowest rank goes first, from left to right. Pieces don't touch, so each ends as if it had
        been merged alone, and a piece of any length costs a queue step per merge.
        """
        if not pieces:
            return []
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        ids = self.single[data].tolist()
        last = np.zeros(len(data), bool)
        last[ends - 1] = True
        after = np.where(last, -1, np.arange(1, len(data) + 1)).tolist()
        before = np.where(np.roll(last, 1), -1, np.arange(-1, len(data) - 1)).tolist()
        ranks = np.where(last, -1, self.bytes_rank[data.astype(np.int64) * 256 + np.roll(data, -1)])
        rank_at, queue, size, rank_of = ranks.tolist(), RankQueue(self.size), self.size, self.pairs.get
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0):]
        if len(order):
            starts = np.flatnonzero(np.diff(ranks[order], prepend=-1))
            for rank, positions in zip(ranks[order[starts]].tolist(), np.split(order, starts[1:]), strict=True):
                queue.open(rank, positions.tolist())
        bucket_of, push = queue.buckets.get, queue.push
        while queue.top:
            rank = queue.first()
            positions = queue.pop(rank)
            for n, i in enumerate(positions):
                if rank_at[i] != rank:
                    continue
                j = after[i]
                ids[i], k, h = rank, after[j], before[i]
                after[i] = k
                ids[j] = rank_at[j] = rank_at[i] = -1
                lower = False
                if k >= 0:
                    before[k] = i
                    if (new := rank_of(rank * size + ids[k], -1)) >= 0:
                        rank_at[i] = new
                        if bucket := bucket_of(new):
                            bucket.append(i)
                        else:
                            push(new, i)
                        lower = new < rank
                if h >= 0:
                    rank_at[h] = new = rank_of(ids[h] * size + rank, -1)
                    if new >= 0:
                        if bucket := bucket_of(new):
                            bucket.append(h)
                        else:
                            push(new, h)
                        lower = lower or new < rank
                if lower:
                    for late in positions[n + 1:]:
                        push(rank, late)
                    break
        coded = np.array(ids, dtype=np.int64)
        tokens = np.concatenate([[0], np.cumsum(coded >= 0)])[np.concatenate([[0], ends])] * 4
        flat = coded[coded >= 0].astype("<u4").tobytes()
        return [flat[i:j] for i, j in zip(tokens[:-1].tolist(), tokens[1:].tolist(), strict=True)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[tuple[int, str], tuple[ByteBpe, TextCoder]] = {}


def _coder(file: Broadcast, pattern: str) -> tuple[ByteBpe, TextCoder]:
    """The vocabulary in this Python worker, read once and kept with what it has coded."""
    key = (hash(file.value), pattern)
    if key not in _loaded:
        bpe = ByteBpe(file.value)
        _loaded.clear()
        _loaded[key] = bpe, TextCoder(pattern, bpe.encode_pieces)
    return _loaded[key]


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file, whose size is fixed by its vocabulary, for all executors."""
    ship(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian 32-bit integers), decoded (the bytes the ids stand for).

    No special tokens: their strings are ordinary text. Null text counts as empty and has no ids;
    repeated rows are coded each; an empty table gives no rows.
    """
    file = vocabulary(docs.sparkSession, path)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, coder = _coder(file, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids = list(coder(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.binary())], ["doc_id", "ids", "decoded"])

    coded = rows.mapInArrow(code, f"doc_id {id_type}, ids binary, decoded binary")
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")
