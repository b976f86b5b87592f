"""BPE against its library on whole texts, token files against theirs, and round trips."""

import base64
import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelhouse.llm import byte_bpe, pieces, queries, token_files
from reelhouse.llm.pieces import TextCoder

RANKS, JSON = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
HOSTILE = ["", None, " ", "  two  spaces ", "a\n b", "a \nb", "a\n \nb", "don't we'll", "x" * 20_000, " " * 500, "ab" * 4000, "tab\t\ttab", "é😀 你好　世界", "<|endoftext|> ok",
           "\x00\x1c \x85", "1234 5678", "word" * 3000 + " end"]


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(open(RANKS, "rb").read())


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def _fuzz(n):
    rng = random.Random(1)
    letters = " \t\n 　\x1c\x85ab1é'sſ你😀́-_.<|>"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_every_text_is_coded_as_the_library_does(bpe, reference):
    texts = [t or "" for t in HOSTILE] + _fuzz(3000)
    for text, ids in zip(texts, TextCoder(public_tokenizers.PATTERN, bpe.encode_pieces)(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_code_points_split_as_the_library_does(bpe, reference):
    points = [chr(i) for i in [*range(0x3100), *range(0x3100, 0x110000, 37)] if not 0xD800 <= i < 0xE000]
    texts = [f"a{c} b{c}1 {c}  z" for c in points]
    for text, ids in zip(texts, TextCoder(public_tokenizers.PATTERN, bpe.encode_pieces)(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_new_chunks_go_through_the_pattern_together(bpe, reference):
    coder, calls = TextCoder(public_tokenizers.PATTERN, bpe.encode_pieces), []
    find = coder.find
    coder.find = lambda text: calls.append(text) or find(text)
    texts = [f"head w{i}, w{i}.\nNext {i}" for i in range(500)]
    for text, ids in zip(texts, coder(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert len(calls) == 2  # the one head, and all chunks


def test_a_memory_that_is_full_keeps_what_comes_again(bpe, reference, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNKS", 2000)
    coded = []
    coder = TextCoder(public_tokenizers.PATTERN, lambda new: coded.extend(new) or bpe.encode_pieces(new), 2000)
    rng = random.Random(6)
    texts = [" ".join(["a", "again", "often,", *(f"once{rng.randrange(10**6)}x" for _ in range(20))]) + rng.choice(["", "  odd", "\n \n"]) for _ in range(300)]
    for text, ids in zip(texts, coder(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert coded.count(" again") == 1 and coded.count(" often") == 1
    assert len(coder.pieces) < 2000 < len(coded)


def test_rank_queue_gives_the_lowest_rank():
    rng, queue, held = random.Random(2), byte_bpe.RankQueue(300_000), {}
    for step in range(5000):
        if held and rng.random() < 0.4:
            rank = queue.first()
            assert rank == min(held) and queue.pop(rank) == sorted(held.pop(rank))
        else:
            rank = rng.choice([rng.randrange(300_000), rng.randrange(50)])
            queue.push(rank, step)
            held.setdefault(rank, []).append(step)


def test_a_lower_rank_that_a_merge_makes_goes_first():
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"abc", b"ab", b"abab", b"aa", b"aaa"]
    shuffled = byte_bpe.ByteBpe(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate([*tokens[:256], b"abc", b"ab", b"bca", b"bc", b"aa", b"aaa", b"cab"])))
    library = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks=shuffled.ranks, special_tokens={})
    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    for word, ids in zip(words, shuffled.encode_pieces(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(word)


def test_documents_round_trip(documents, reference):
    docs = documents([(i, t) for i, t in enumerate([*HOSTILE, *_fuzz(300)])] + [(None, "no id"), (3, "again"), (3, "again")]).withColumn("ids", F.lit(1))
    got = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id not in (None, 3)}
    for r in got:
        assert r.n_tokens == len(r.ids) // 4
        if r.doc_id in texts:
            assert np.frombuffer(bytes(r.ids), "<u4").tolist() == reference.encode_ordinary(texts[r.doc_id])
            assert bytes(r.decoded) == texts[r.doc_id].encode()
    assert byte_bpe.encode_documents(documents([]), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("n, longest", [(1, 20), (2, 20), (300, 20), (300, 9), (5000, 14)])
def test_codes_are_prefix_free_and_short(n, longest):
    counts = np.random.default_rng(n).zipf(1.3, n).clip(max=10**9)
    bits = token_files.code_lengths(counts, longest)
    assert bits.max() <= longest and (n == 1 or np.isclose((2.0 ** -bits).sum(), 1))
    assert (np.diff(bits[np.lexsort((bits, -counts))]) >= 0).all()
    heap = counts.tolist()
    heapq.heapify(heap)
    least = 0
    while len(heap) > 1:
        least += (both := heapq.heappop(heap) + heapq.heappop(heap))
        heapq.heappush(heap, both)
    assert (counts * bits).sum() >= least
    if n > 1 and longest < 20 or n == 2:
        return
    assert n == 1 or (counts * token_files.code_lengths(counts, 60)).sum() == least


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 5000])
def test_blocks_decode_by_themselves(n):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.4, n).clip(max=50_000)
    used, counts = np.unique(ids, return_counts=True)
    code = token_files.Code(used, token_files.code_lengths(counts))
    assert (code.read(*code.write(ids), n) == ids).all()


def test_files_hold_all_ids_in_order(documents, spark):
    rng = random.Random(9)
    order = [t for t in [*HOSTILE, *_fuzz(500)]]
    docs = list(enumerate(order))
    rng.shuffle(docs)
    got = {r.doc_id: r for r in token_files.round_trip(documents(docs), JSON, public_tokenizers.PATTERN, 2).collect()}
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    start = 0
    for i, text in enumerate(order):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_odd_tables(documents):
    assert token_files.round_trip(documents([]), JSON, public_tokenizers.PATTERN, 2).count() == 0
    got = token_files.round_trip(documents([(1, "a"), (1, "a"), (None, None), (1, "b")]), JSON, public_tokenizers.PATTERN, 2).collect()
    assert sorted((r.start, r.n_tokens) for r in got) == [(0, 1), (1, 2), (3, 2), (5, 2)]
    assert min(got, key=lambda r: r.start).doc_id is None


def test_query_codes_added_tokens_as_the_library_does(documents, spark, folder):
    end = "<|endoftext|>"
    texts = [t or "" for t in HOSTILE] + [f"a {end} b", end, f"{end}{end}", f"x{end}y  \n{end} ", f"{end[:-1]} >", "<|endof text|>", f"don't{end}'t {'word ' * 500}"]
    library, start = Tokenizer.from_file(JSON), 0
    got = {r.doc_id: r for r in queries.op8_token_files(spark, folder(documents=documents(list(enumerate(texts))))).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pieces_merged_together_fill_bounded_lists(bpe, reference, monkeypatch):
    rng, sizes, merge = random.Random(5), [], bpe._merge
    monkeypatch.setattr(bpe, "_merge", lambda held: sizes.append(sum(map(len, held))) or merge(held))
    words = [" " + "".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(20_000)]
    for word, ids in zip(words, bpe.encode_pieces(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(word)
    assert max(sizes) < 300_000 and sum(sizes) == sum(map(len, words))
