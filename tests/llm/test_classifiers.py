"""Toxicity and language: held-out accuracy, counterfactual swaps, hostile rows."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import language, toxicity

GOOD = "the a river green stone bread window morning paper garden walk house lamp road cloud".split()
BAD = ["stupidhead", "vileworm", "trashface"]


def _sentence(rng, toxic, who=None):
    words = [rng.choice(GOOD) for _ in range(rng.randrange(5, 40))]
    if toxic:
        words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "ish"]))
    if who:
        words.insert(rng.randrange(len(words)), who)
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(i, _sentence(rng, i % 5 == 0), int(i % 5 == 0)) for i in range(1500)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").cache()
    return docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int").cache()


def test_toxic_words_and_their_forms_are_found(spark, labelled):
    docs, labels = labelled
    model = toxicity.learn_model(docs, labels, ~toxicity.held_out())
    rated = toxicity.scored(docs, model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    assert len(rated) > 200 and np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in rated]) > 0.98
    unseen = spark.createDataFrame([("a river " + "stone " * 3000 + "VILEWORMED!",), ("a river",), (None,), ("",)], "text string")
    assert [r.score >= 0.5 for r in toxicity.scored(unseen, model).collect()] == [True, False, False, False]


def test_held_out_labels_are_never_learned(spark, labelled):
    docs, labels = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.learn_model(docs, x, ~toxicity.held_out()) for x in (labels, flipped))
    assert (one.buckets == two.buckets).all() and np.allclose(one.weights, two.weights) and one.bias == two.bias


def test_swapping_identity_terms_changes_little(spark):
    """Toxic sentences mostly mention one group: the penalty keeps a neutral mention from being rejected for it."""
    rng = random.Random(2)
    rows = [(i, _sentence(rng, i % 2 == 0, "muslim" if (i % 2 == 0) == (rng.random() < 0.9) else "christian"), int(i % 2 == 0)) for i in range(800)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").cache()
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    neutral = spark.createDataFrame([(0, "a muslim walk"), (1, "a christian walk"), (2, "a walk")], "id int, text string")

    def gap(penalty):
        model = toxicity.learn_model(docs, labels, F.lit(True), penalty)
        scores = [r.score for r in toxicity.scored(neutral, model).orderBy("id").collect()]
        rated = toxicity.scored(docs, model).join(labels, "doc_id").collect()
        return max(scores) - min(scores), np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in rated])

    (plain, _), (fair, right) = gap(0.0), gap(toxicity.SWAP_PENALTY)
    assert fair < 0.1 < plain and right > 0.95


def test_swaps_of_a_text():
    versions = toxicity.swaps("The Women met a man.")
    assert versions == ["the men met a person.", "the people met a .", "the  met a woman."]
    assert toxicity.swaps("nothing here") == []


def test_stretches_cover_the_text():
    for text in (None, "", "a b", "word " * 9000, "x" * 50_000, " " * 30_000, "é" * 8192 + " " + "y" * 9000):
        parts = toxicity.stretches(text)
        assert "".join(parts) == (text or "") and max(map(len, parts)) <= 2 * toxicity.STRETCH and len(parts) >= 1


def test_the_given_labels_are_fitted_with_counterfactuals(spark):
    """No labelled text of the given tables holds an identity term, so neutral mentions are added; the fit hears of them."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn_model(docs, labels, ~toxicity.held_out())
    plain = toxicity.learn_model(docs, labels, ~toxicity.held_out(), 0.0)
    print("counterfactual pairs:", model.pairs)
    assert model.pairs > 100
    texts = [r.text or "" for r in docs.limit(300).collect()]
    reader = toxicity.Reader(model.buckets)

    def change(m):
        return np.mean([abs(toxicity.logit(v, m, reader) - toxicity.logit(t, m, reader)) for t in texts for g in toxicity.IDENTITY for v in [f"{t[:4000]} {g[0]}"]
                        if len(t) < 4000])

    assert change(model) <= change(plain)


def test_long_texts_are_judged_by_their_passages(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model, marked = toxicity.learn_model(docs, labels, ~toxicity.held_out()), docs.join(labels, "doc_id").cache()
    reader = toxicity.Reader(model.buckets)
    clean = [r.text for r in marked.where("toxic = 0 AND text IS NOT NULL").orderBy("doc_id").collect()]
    toxic = [r.text for r in marked.where("toxic = 1").orderBy("doc_id").limit(40).collect()]
    kept = [t for t in clean if toxicity.logit(t, model, reader) < 0]
    assert len(kept) > 0.995 * len(clean)
    long = "\n".join(kept)[:2_000_000]
    assert len(long) == 2_000_000 and toxicity.logit(long, model, reader) < 0
    found = [toxicity.logit(long[:500_000] + " " + t + " " + long[500_000:1_000_000], model, reader) > 0 for t in toxic]
    assert sum(found) >= 24  # measured: 29; the whole texts at once would all be taken as toxic or all as clean


def test_hostile_labels(spark, labelled):
    docs, labels = labelled
    more = labels.union(labels).union(spark.createDataFrame([(None, 1), (10**9, 1), (3, None)], "doc_id long, toxic int"))
    twice = docs.union(docs.limit(50)).union(spark.createDataFrame([(None, "a vileworm"), (None, None)], "doc_id long, text string"))
    odd = twice.withColumn("_toxicity", F.lit("x"))
    kept = toxicity.clean_documents(odd, more)
    assert kept.columns == odd.columns and kept.where("doc_id IS NULL").count() == 1 and kept.where("_toxicity <> 'x'").count() == 0


def test_toxicity_without_usable_labels(spark, labelled):
    docs, labels = labelled
    for odd in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        model = toxicity.learn_model(docs, odd, F.lit(True))
        assert toxicity.scored(docs, model).where("score >= 0.5").count() == 0
    assert toxicity.clean_documents(docs.limit(0), labels).count() == 0


def test_clean_documents_keep_their_columns(labelled):
    docs, labels = labelled
    odd = docs.withColumn("score", F.lit("x")).withColumn("toxic", F.lit(None).cast("string"))
    kept = toxicity.clean_documents(odd, labels)
    assert kept.columns == odd.columns and 1150 < kept.count() < 1260


TONGUES = {"aa": "kala mira tonu selo vanu riko", "bb": "straft glomp knurz blitz dorf wund", "cc": "élan çava où très brûlé nuît"}


def _speech(rng, lang, n):
    return " ".join(rng.choice(TONGUES[lang].split()) + rng.choice(["", "a", "en"]) for _ in range(n))


def test_languages_of_unseen_texts(spark):
    rng = random.Random(3)
    rows = [(i, _speech(rng, lang, rng.randrange(1, 60)), lang) for i in range(600) for lang in [rng.choice(list(TONGUES))]]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 -- 34", "bb"), (1003, _speech(rng, "bb", 40_000), None), (None, _speech(rng, "aa", 20), "bb"), (1, "straft", "bb")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = language.identify(docs, F.col("doc_id") % 3 != 1).collect()
    assert len(got) == 606
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 3 == 1]
    assert np.mean([r.lang == r.lang_pred for r in unseen]) > 0.95 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 1000}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "bb", "aa"]


def test_language_is_never_an_input(spark):
    rng = random.Random(4)
    rows = [(i, _speech(rng, "aa" if i % 2 else "bb", 20), "aa" if i % 2 else "bb") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    other = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 1, F.lit("zz")).otherwise(F.col("lang")))
    learn = F.col("doc_id") % 3 != 1
    same = [language.identify(d, learn).select("doc_id", "lang_pred", "score").orderBy("doc_id").collect() for d in (docs, other)]
    assert same[0] == same[1]


def test_kernel_is_the_presence_kernel():
    texts = ["kala mira", "mira tonu", "straft"]
    found = [set(language.grams(t).tolist()) for t in texts]
    x = language._rows([language.grams(t) for t in texts])
    expected = [[len(a & b) / np.sqrt(len(a) * len(b)) for b in found] for a in found]
    assert np.allclose(x @ x.T, expected, atol=1e-6)


def test_no_language_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.identify(docs, F.lit(True)).collect()] == ["und"]
    assert language.identify(docs.limit(0), F.lit(True)).count() == 0


def test_sample_takes_different_texts_and_no_more_than_wanted(spark):
    rng = random.Random(7)
    texts = {"aa": [_speech(rng, "aa", 12) for _ in range(3)] * 500, "bb": [_speech(rng, "bb", 12) for _ in range(900)] + ["straft glomp"] * 2000, "cc": [_speech(rng, "cc", 12)] * 800,
             "dd": ["12 -- 34"] * 300 + [f"{i}" for i in range(300)] + ["mira"]}
    docs = spark.createDataFrame([(t, lang) for lang, own in texts.items() for t in own], "text string, lang string").repartition(8)
    found = language.sample(docs, F.lit(True), rows=120, least=5)
    assert found.groupby("lang").size().to_dict() == {"aa": 3, "bb": 30, "cc": 1, "dd": 1}
    assert not found.duplicated().any()


def test_long_texts_of_rich_vocabulary(spark):
    """Every language has all letters, in shares of its own, so that texts of megabytes hold nearly all n-grams."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    shares = {lang: rng.dirichlet(np.full(len(letters), 2.0)) * 0.9 + 0.1 / len(letters) for lang in ("aa", "bb", "cc")}

    def prose(lang, n):
        return "".join(rng.choice(letters, n, p=shares[lang]))

    rows = [(prose(lang, int(rng.integers(500, 4000))), lang) for lang in shares for _ in range(60)] + [(prose("aa", 200_000), "aa")]
    model = language.fit(language.sample(spark.createDataFrame(rows, "text string, lang string"), F.lit(True)))
    got = language.predict([prose(lang, 3_000_000) for lang in shares] + ["12 " * 20_000, " " * 50_000 + prose("bb", 2000)], model)
    assert got["lang"].tolist() == ["aa", "bb", "cc", "und", "bb"] and (got["score"][:3] > 0.5).all()
    assert all("".join(s[:len(s) - 3] for s in own[:-1]) + own[-1] == t for t in ("", "ab", "x" * 16385, prose("cc", 70_001)) for own in [language.stretches(t)])


def test_remembered_chunks_take_few_bytes_a_feature():
    rng = random.Random(3)
    chunks = ["".join(rng.choice("abcdefghijklmnop") for _ in range(12)) for _ in range(3000)]
    reader = toxicity.Reader()
    tracemalloc.start()
    for at in range(0, len(chunks), 10):
        reader(" ".join(chunks[at:at + 10]))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(reader.chunks) == 3000 and held < 16 * sum(map(len, reader.chunks.values()))
