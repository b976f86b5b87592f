"""Registered queries on the smallest benchmark folder, and the pipeline against its parts done plainly."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from reelhouse.llm import byte_bpe, mixing, near_dedup, toxicity
from reelhouse.llm.common import table
from reelhouse.llm.queries import CHECKS, QUERIES
from tests.conftest import TESTDATA


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_a_row_each(spark, name):
    found = QUERIES[name](spark, TESTDATA).collect()
    source = {"op4_main_text": "pages", "op5_vector_search": "embeddings"}.get(name, "documents")
    rows = duckdb.sql(f"SELECT count(*) FROM '{TESTDATA}/{source}.parquet'").fetchall()[0][0]
    if name == "op5_vector_search":
        assert len(found) == 20 * duckdb.sql(f"SELECT count(*) FROM '{TESTDATA}/embeddings.parquet' WHERE vec_id % 20 = 0").fetchall()[0][0]
    elif name != "op12_prefix_trie":
        assert len(found) == rows


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_its_check(spark, name):
    found = QUERIES[name](spark, TESTDATA)
    duck = duckdb.connect()
    for source in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {source} AS SELECT * FROM '{TESTDATA}/{source}.parquet'")
    cursor = duck.execute(CHECKS[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert Counter(map(tuple, found.select(columns).collect())) == Counter(cursor.fetchall())


def test_stages_do_what_their_parts_do(spark):
    docs = table(spark, TESTDATA, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, TESTDATA), f"test-{name}")
        assert docs.columns == columns
        seen[name] = docs
    start = table(spark, TESTDATA, "documents")
    model = toxicity.learn_model(start, table(spark, TESTDATA, "labels"), ~toxicity.held_out())
    reader = toxicity.Reader(model.buckets)
    clean = {r.doc_id: r.text for r in start.collect() if toxicity.logit(r.text, model, reader) < 0}
    assert {r.doc_id for r in seen["toxicity"].collect()} == set(clean)
    first = {}
    for i, text in sorted(clean.items()):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text), i)
    assert {r.doc_id for r in seen["exact_dedup"].collect()} == set(first.values())
    classes = near_dedup.near_duplicates(seen["exact_dedup"]).collect()
    assert {r.doc_id for r in seen["near_dedup"].collect()} == {r.class_id for r in classes}
    plan = {r.doc_id: r.copies for r in mixing.mix(seen["near_dedup"]).collect()}
    mixed = [r.doc_id for r in seen["mixing"].collect()]
    assert {i: mixed.count(i) for i in plan} == plan


def test_pipeline_rows(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"] and corpus_pipeline.ORACLE_SQL is None
    bpe = byte_bpe.ByteBpe(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{TESTDATA}/documents.parquet'").fetchall())
    found = corpus_pipeline.run(spark, TESTDATA).collect()
    assert len(found) > 50
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert r.n_tokens == len(ids) and ids.tolist() == library.encode_ordinary(texts[r.doc_id])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, TESTDATA, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
