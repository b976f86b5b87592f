"""Token files: ids in ascending doc_id order, Huffman-coded in blocks that decode by themselves.

A set of token files is a folder with two Parquet tables, so that Spark commits and splits them in any store:

``code``    one row per used id: id, bits. Codes are canonical: by length, then id, counting up.
``blocks``  one row per block of whole documents: part and start (tokens before it in the part), doc_ids,
            lengths, checkpoints (bit offset of every CHECK_EVERYth token), payload (big-endian bits).

Parts follow each other in doc_id order, and so do the blocks of a part by start.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reelhouse.llm.common import ship, stored
from reelhouse.llm.pieces import TextCoder
from reelhouse.sources.tables import shared_folder

LONGEST = 20  # bits of the longest code; the decoding table has 2**LONGEST places
CHECK_EVERY = 128
BLOCK_TOKENS = 1 << 17
ROWS_AT_ONCE, CHARS_AT_ONCE = 4096, 1 << 23
_SHOWN = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
# Byte-level vocabularies spell a byte by its own character where that shows, else by the next character from 256 on.
_LETTERS = {b: b for b in _SHOWN} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
BYTE_LETTERS = np.array([_LETTERS[b] for b in range(256)], "<u4")
STAGED = "part long, pos long, start long, doc_id long, ids binary, counts binary"
BLOCKS = "part long, start long, tokens long, doc_ids array<long>, lengths array<int>, checkpoints binary, payload binary"

_loaded: dict[tuple[int, str, bool], Callable[[list[str]], list[bytes]]] = {}


def _coder(file: Broadcast, pattern: str, kind: str, added: bool) -> Callable[[list[str]], list[bytes]]:
    key = (hash(file.value), pattern, added)
    if key not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_str(file.value)
        library = Tokenizer.from_str(file.value)
        marks = [t.content for t in library.get_added_tokens_decoder().values()] if added else []

        tokenise, size = tokenizer.model.tokenize, np.dtype(kind).itemsize
        if not isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) or tokenizer.normalizer is not None:
            raise ValueError("the tokenizer file is not byte-level")

        def code(pieces: list[str]) -> list[bytes]:
            """Pre-tokens in the vocabulary's spelling of bytes, each coded by the library's model."""
            # Spelled together; 255, which UTF-8 doesn't use, parts them.
            plain = np.frombuffer("\udcff".join(pieces).encode("utf-8", "surrogateescape"), np.uint8)
            spelled = BYTE_LETTERS[plain].tobytes().decode("utf-32-le").split("\xff")
            found = [[token.id for token in tokenise(p)] for p in spelled]
            ids = np.array(list(chain.from_iterable(found)), kind).tobytes()
            ends = (np.cumsum([0, *map(len, found)]) * size).tolist()
            return [ids[start:end] for start, end in pairwise(ends)]

        by_pieces = TextCoder(pattern, code, CHARS_AT_ONCE)

        def code_texts(texts: list[str]) -> list[bytes]:
            marked = {i: t for i, t in enumerate(texts) if any(m in t for m in marks)}
            ids = list(by_pieces("" if i in marked else t for i, t in enumerate(texts)))
            for i, text in marked.items():
                ids[i] = np.array(library.encode(text, add_special_tokens=False).ids, kind).tobytes()
            return ids

        _loaded.clear()
        _loaded[key] = code_texts
    return _loaded[key]


def id_kind(path: str, end_id: int) -> str:
    """How staged ids are held: 16 bits where the vocabulary allows."""
    from tokenizers import Tokenizer

    return "<u2" if max([*Tokenizer.from_file(path).get_vocab().values(), end_id]) < 1 << 16 else "<u4"


def tokenised(docs: DataFrame, path: str, pattern: str, end_id: int, doc_id: str = "doc_id", text: str = "text", added: bool = False) -> DataFrame:
    """Stored rows (part, pos, start, doc_id, ids, counts) in ascending doc_id order, null ids first.

    Each task codes one range of doc_ids; part is its number, pos and start the documents and tokens
    before the row in it. Equal doc_ids are ordered by a hash of their text. Null text counts as empty: its only token is
    ``end_id``. One more row per task, without ids, counts all its ids. With ``added``, strings of the file's added
    tokens get their ids, as in the library's own call; without, they are ordinary text.
    """
    with open(path) as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # Rows of one doc_id, or without one, are many at will: the second key deals them out.
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    kind = id_kind(path, end_id)
    end, size = np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, pos, start, total = _coder(file, pattern, kind, added), TaskContext.get().partitionId(), 0, 0, np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(at, ROWS_AT_ONCE)
                ids = [own + end for own in coder(rows.column(1).to_pylist())]
                n = np.array([len(i) // size for i in ids], np.int64)
                starts = start + np.cumsum(n) - n
                seen = np.bincount(np.frombuffer(b"".join(ids), kind), minlength=len(total))
                seen[:len(total)] += total
                total = seen
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids), part, np.int64)), pa.array(np.arange(pos, pos + len(ids))), pa.array(starts),
                    rows.column(0), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary()),
                ], ["part", "pos", "start", "doc_id", "ids", "counts"])
                pos, start = pos + len(ids), start + int(n.sum())
        yield pa.RecordBatch.from_arrays([
            pa.array([part]), pa.array([-1]), pa.array([-1]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary()),
        ], ["part", "pos", "start", "doc_id", "ids", "counts"])

    return stored(ordered.mapInArrow(code, STAGED), "token-ids")


def id_counts(staged: DataFrame) -> DataFrame:
    """(id, n) over all tokens, summed from the tasks' own counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                own = np.frombuffer(counts.as_py(), np.int64)
                both = np.zeros(max(len(own), len(total)), np.int64)
                both[:len(own)] += own
                both[:len(total)] += total
                total = both
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    found = staged.where("counts IS NOT NULL").select("counts")
    return found.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of an optimal prefix code with no code over ``longest`` bits (package-merge)."""
    n = len(counts)
    if n == 1:
        return np.ones(1, np.int64)
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    packages, leaf_flags = np.zeros(0), []
    for _ in range(max(longest, int(np.ceil(np.log2(n))))):
        both = np.concatenate([weights, packages])
        place = np.argsort(both, kind="stable")
        leaf_flags.append(place < n)
        both = both[place]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for leaves in reversed(leaf_flags):
        chosen = int(leaves[:take].sum())
        bits[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.empty(n, np.int64)
    out[order] = bits
    return out


class Code:
    """A canonical code: for writing, the bits of each id; for reading, a table over the next ``longest`` bits."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray) -> None:
        order = np.lexsort((ids, bits))
        ids, bits = ids[order].astype(np.int64), bits[order].astype(np.int64)
        self.longest = int(bits.max())
        spans = np.int64(1) << (self.longest - bits)
        first = np.cumsum(spans) - spans
        self.bits_of, self.code_of = np.zeros(ids.max() + 1, np.int64), np.zeros(ids.max() + 1, np.uint64)
        self.bits_of[ids], self.code_of[ids] = bits, (first >> (self.longest - bits)).astype(np.uint64)
        self.table_id, self.table_bits = np.repeat(ids, spans).astype(np.uint32), np.repeat(bits, spans).astype(np.int64)
        rest = (1 << self.longest) - len(self.table_id)  # only a lone code leaves places unused
        self.table_id, self.table_bits = np.pad(self.table_id, (0, rest), mode="edge"), np.pad(self.table_bits, (0, rest), mode="edge")

    def write(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Payload and checkpoints."""
        bits = self.bits_of[ids]
        at = np.cumsum(bits) - bits
        value = self.code_of[ids] << (64 - (at & 31) - bits).astype(np.uint64)
        word, size = at >> 5, int(at[-1] + bits[-1] + 31 >> 5) + 1
        # Bits of different codes are disjoint, so sums of halves stay exact.
        total = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size) + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size + 1)[:size]
        return total.astype(">u4").tobytes(), at[::CHECK_EVERY].astype("<u8").tobytes()

    def read(self, payload: bytes, checkpoints: bytes, tokens: int) -> np.ndarray:
        """All stretches between checkpoints advance together, a token per step."""
        at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
        words = np.frombuffer(payload + bytes(CHECK_EVERY * self.longest // 8 + 16 & ~3), ">u4").astype(np.uint64)
        both = words[:-1] << np.uint64(32) | words[1:]
        out = np.empty((CHECK_EVERY, len(at)), np.uint32)
        mask, shift = np.int64((1 << self.longest) - 1), 64 - self.longest
        for step in range(min(CHECK_EVERY, tokens)):
            seen = (both[at >> 5] >> (shift - (at & 31)).astype(np.uint64)).astype(np.int64) & mask
            out[step] = self.table_id[seen]
            at += self.table_bits[seen]
        return out.T.reshape(-1)[:tokens]


def write_files(staged: DataFrame, folder: str, kind: str) -> None:
    """Code the staged ids, held as ``kind``, by their global counts into a new ``folder``."""
    spark = staged.sparkSession
    ship(spark)
    counts = id_counts(staged).toPandas()  # one row per id of the vocabulary at most
    if len(counts):
        counts["bits"] = code_lengths(counts["n"].to_numpy())
    else:
        counts["bits"] = counts["n"]
    spark.createDataFrame(counts[["id", "bits"]], "id long, bits long").coalesce(1).write.parquet(f"{folder}/code")
    table = spark.sparkContext.broadcast((counts["id"].to_numpy(np.int64), counts["bits"].to_numpy(np.int64)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, held, size, following = None, [], 0, None
        for batch in batches:
            code = code or Code(*table.value)
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for part, pos, start, doc_id, ids in zip(*columns, strict=True):
                if held and (size >= BLOCK_TOKENS or following != (part, pos)):
                    yield _block(code, held)
                    held, size = [], 0
                held.append((part, start, doc_id, np.frombuffer(ids, kind)))
                size += len(held[-1][3])
                following = (part, pos + 1)
        if held:
            yield _block(code, held)

    rows = staged.where("ids IS NOT NULL").select("part", "pos", "start", "doc_id", "ids")
    rows.mapInArrow(blocks, BLOCKS).write.parquet(f"{folder}/blocks")


def _block(code: Code, held: list) -> pa.RecordBatch:
    payload, checkpoints = code.write(np.concatenate([h[3] for h in held]))
    lengths = [len(h[3]) for h in held]
    return pa.RecordBatch.from_pylist([{
        "part": held[0][0], "start": held[0][1], "tokens": sum(lengths), "doc_ids": [h[2] for h in held], "lengths": lengths,
        "checkpoints": checkpoints, "payload": payload,
    }], pa.schema([
        ("part", pa.int64()), ("start", pa.int64()), ("tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())), ("checkpoints", pa.binary()), ("payload", pa.binary()),
    ]))


def read_files(spark: SparkSession, folder: str, each: Callable[[np.ndarray], object], column: str) -> DataFrame:
    """One row per document, read from the files: doc_id, start (tokens of all documents before it), n_tokens,
    and ``each`` of its ids as ``column`` ("name type")."""
    ship(spark)
    code = spark.read.parquet(f"{folder}/code").toPandas()  # the vocabulary at most
    table = spark.sparkContext.broadcast((code["id"].to_numpy(np.int64), code["bits"].to_numpy(np.int64)))
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    rows = blocks.join(starts, "part").select(
        (F.col("part_start") + F.col("start")).alias("start"), "tokens", "doc_ids", "lengths", "checkpoints", "payload")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = None
        for batch in batches:
            code = code or Code(*table.value)
            for row in range(batch.num_rows):
                start, tokens, doc_ids, lengths, checkpoints, payload = (batch.column(i)[row].as_py() for i in range(6))
                ids = code.read(payload, checkpoints, tokens)
                ends = np.cumsum(np.array(lengths, np.int64))
                found = [each(ids[end - n:end]) for end, n in zip(ends.tolist(), lengths, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64()), pa.array(start + ends - np.array(lengths)), pa.array(lengths, pa.int64()), pa.array(found),
                ], ["doc_id", "start", "n_tokens", column.split()[0]])

    return rows.mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def round_trip(docs: DataFrame, path: str, pattern: str, end_id: int, each: Callable = ids_crc32, column: str = "ids_crc32 long", added: bool = False) -> DataFrame:
    """Tokenise, write the files under the shared folder, and read them back."""
    folder = f"{shared_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex[:12]}"
    write_files(tokenised(docs, path, pattern, end_id, added=added), folder, id_kind(path, end_id))
    return read_files(docs.sparkSession, folder, each, column)
