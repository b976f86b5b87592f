"""Pre-token splitting with a bounded memory of what was coded before, shared by the tokenising operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Chunks and pre-tokens remembered by one Python worker, and characters coded together.
CHUNKS = 800_000
CHARS_AT_ONCE = 1 << 22


class Memory:
    """Strings with the bytes of their ids (null: none of their own), held and looked up as Arrow arrays."""

    def __init__(self) -> None:
        self.keys, self.ids, self.again = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, bool)

    def __len__(self) -> int:
        return len(self.keys)

    def ids_of(self, keys: pa.Array, learn: Callable[[list[str]], pa.Array]) -> pa.Array:
        """Ids of different ``keys``; ``learn`` gives those of keys not held."""
        place = pc.index_in(keys, self.keys).fill_null(-1).to_numpy().astype(np.int64)
        new = place < 0
        self.again[place[~new]] = True
        if new.any():
            unknown = keys.filter(pa.array(new))
            place[new] = np.arange(len(self), len(self) + len(unknown))
            self.ids = pa.concat_arrays([self.ids, learn(unknown.to_numpy(zero_copy_only=False).tolist())])
            self.keys, self.again = pa.concat_arrays([self.keys, unknown]), np.pad(self.again, (0, len(unknown)))
        return self.ids.take(pa.array(place))

    def forget(self, most: int) -> None:
        """Keep what was met again since the last time, unless that is more than ``most``."""
        keep = self.again if self.again.sum() <= most else np.zeros(len(self), bool)
        self.keys, self.ids = self.keys.filter(pa.array(keep)), self.ids.filter(pa.array(keep))
        self.again = np.zeros(len(self.keys), bool)


def strung(ids: pa.Array, place: np.ndarray, begin: np.ndarray) -> pa.Array:
    """The ids at ``place`` strung together, one value from each place in ``begin`` to the next."""
    taken = ids.take(pa.array(place))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(place) + 1] if len(place) else np.zeros(1, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(ends[begin].tobytes()), taken.buffers()[2]])


class TextCoder:
    """Codes whole texts, each match of ``pattern`` by itself.

    ``code`` maps different pre-tokens to the bytes of their ids. Texts are cut at single spaces first:
    a space before something else than white space always starts a pre-token, so the chunk after
    it can be coded and remembered by itself. A text with other spacing goes through the
    pattern as a whole. Chunks are cut, told apart, looked up and put together in Arrow arrays; Python sees the new ones.
    """

    def __init__(self, pattern: str, code: Callable[[list[str]], list[bytes]], chars_at_once: int = CHARS_AT_ONCE) -> None:
        self.find, self.code, self.chars_at_once = regex.compile(pattern).findall, code, chars_at_once
        self.chunks, self.pieces = Memory(), Memory()  # chunks without the space before them, pre-tokens with it

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for held in self._together(texts, self.chars_at_once):
            yield from self._coded(held)

    @staticmethod
    def _together(texts: Iterable[str | None], most: int) -> Iterator[list[str]]:
        held, chars = [], 0
        for text in texts:
            held.append(text or "")
            chars += len(held[-1])
            if chars >= most:
                yield held
                held, chars = [], 0
        if held:
            yield held

    def _coded(self, texts: list[str]) -> Iterator[bytes]:
        for memory in (self.chunks, self.pieces):
            if len(memory) > CHUNKS // 2:
                memory.forget(CHUNKS * 3 // 8)
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        begin = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        place, heads = coded.indices.to_numpy().astype(np.int64), [t.partition(" ")[0] for t in texts]
        own_heads = {h: i for i, h in enumerate(dict.fromkeys(heads))}
        rest = np.ones(len(place), bool)
        rest[begin[:-1]] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[place[rest]] = True
        found = self.chunks.ids_of(coded.dictionary.filter(pa.array(used)), self._chunk_ids)
        place = (np.cumsum(used) - 1)[place]
        place[begin[:-1]] = [len(found) + own_heads[h] for h in heads]
        found = pa.concat_arrays([found, self._joined([self.find(h) for h in own_heads])])
        odd = np.concatenate([[0], np.cumsum(found.is_null().to_numpy(zero_copy_only=False)[place])])[begin]
        joined = strung(found.fill_null(b""), place, begin)
        # Texts with a chunk that depends on its neighbours.
        whole = (t for t, more in zip(texts, np.diff(odd).tolist(), strict=True) if more)
        others = (ids.as_py() for held in self._together(whole, self.chars_at_once // 4) for ids in self._joined([self.find(t) for t in held]))
        ends, data = np.frombuffer(joined.buffers()[1], np.int64).tolist(), memoryview(joined.buffers()[2] or b"")
        for i, more in enumerate(np.diff(odd).tolist()):
            yield next(others) if more else bytes(data[ends[i]:ends[i + 1]])

    def _chunk_ids(self, chunks: list[str]) -> pa.Array:
        """Ids of each chunk with a space before it; null for one that depends on its neighbours."""
        words, mixed, places = [], [], ([], [], [])
        for i, chunk in enumerate(chunks):
            if chunk.isalpha():
                words.append(" " + chunk)
                places[0].append(i)
            elif not chunk or chunk[0].isspace():
                places[2].append(i)
            else:
                mixed.append(chunk)
                places[1].append(i)
        # No chunk holds a space, so one begins wherever a pre-token starts with one.
        parts = self.find(" " + " ".join(mixed)) if mixed else []
        begin = np.flatnonzero(np.array([p[0] == " " for p in words + parts], bool))
        ids = self._piece_ids(words + parts, np.append(begin, len(words) + len(parts)))
        place = np.empty(len(chunks), np.int64)
        place[places[0] + places[1] + places[2]] = np.arange(len(chunks))
        return pa.concat_arrays([ids, pa.nulls(len(places[2]), pa.large_binary())]).take(pa.array(place))

    def _joined(self, texts: list[list[str]]) -> pa.Array:
        """Ids of texts given as their pre-tokens."""
        return self._piece_ids([p for pieces in texts for p in pieces], np.cumsum([0, *map(len, texts)]))

    def _piece_ids(self, pieces: list[str], begin: np.ndarray) -> pa.Array:
        """Ids of pre-tokens, strung together from each place in ``begin`` to the next."""
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        ids = self.pieces.ids_of(coded.dictionary, lambda new: pa.array(self.code(new), pa.large_binary()))
        return strung(ids, coded.indices.to_numpy(), begin)
