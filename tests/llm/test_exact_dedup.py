"""Exact dedup: groups, collisions, hostile rows."""

import hashlib
import re

from pyspark.sql import functions as F

from reelhouse.llm import exact_dedup as ed

ROWS = [(5, "a b"), (3, "a \t\n b"), (9, "a  b "), (4, None), (2, ""), (7, "a b"), (7, "a b"), (None, "a b"), (None, "x"), (8, "é" * 5000), (1, "é" * 5000), (6, "A b")]


def _expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


def test_groups(documents, rows):
    assert rows(ed.exact_groups(documents(ROWS))) == sorted(_expected(ROWS), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_texts_that_share_a_hash_stay_apart(documents, rows):
    weak = lambda text: F.substring(F.md5(text), 1, 1)
    many = [(i, f"text {i % 40}") for i in range(100)] + ROWS
    assert rows(ed.exact_groups(documents(many), hashed=weak)) == rows(ed.exact_groups(documents(many)))
    assert ed.kept_documents(documents(many), hashed=weak).count() == len({r[4] for r in _expected(many)})


def test_kept_documents_keep_their_columns(documents, rows):
    docs = documents(ROWS).withColumn("h", F.lit(1)).withColumn("norm", F.lit("x")).withColumn("first", F.lit(2))
    kept = ed.kept_documents(docs)
    assert kept.columns == docs.columns
    assert [r[0] for r in rows(kept, "doc_id")] == [None, 1, 2, 3, 6, 9]


def test_empty_table(documents):
    empty = documents([])
    assert ed.exact_groups(empty).count() == 0 and ed.kept_documents(empty).count() == 0


def test_one_text_in_a_third_of_all_rows(documents):
    got = ed.exact_groups(documents([(i, "same" if i % 3 == 0 else f"own {i}") for i in range(3000)]))
    assert got.where("keep_id = 0").count() == 1000 and got.where("kept").count() == 2001
