import zlib

import numpy as np

import cases
from pyspark.sql import functions as F
from tidewalk.llm import language, queries


def slow_trigrams(text):
    """Letter trigrams as strings, other runs being one space."""
    out = " "
    for c in text.lower():
        if c.isalpha():
            out += c
        elif out[-1] != " ":
            out += " "
    out += " " if out[-1] != " " else ""
    return [out[i: i + 3] for i in range(len(out) - 2)]


def bucket(gram):
    a, b, c = map(ord, gram)
    mixed = a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D
    return (mixed ^ (mixed >> 17)) % language.BUCKETS


def test_trigrams_are_the_plain_ones():
    for text in ["Hello, World", "a", "", "日本語 x", "é--è  ê", "x" * 10, "1 2 3", "\U0001F600ab\U00020000"]:
        if any(c.isalpha() for c in text):
            assert language.trigrams(text).tolist() == [bucket(g) for g in slow_trigrams(text)], text
        else:
            assert len(language.trigrams(text)) == 0


def test_mixture_is_the_maximum_of_a_plain_estimation():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(language.BUCKETS) * 0.05, 3).T + 1e-9
    p /= p.sum(axis=0)
    grams = [np.concatenate([rng.choice(language.BUCKETS, 400, p=p[:, 0]), rng.choice(language.BUCKETS, 200, p=p[:, 2])]),
             rng.choice(language.BUCKETS, 300, p=p[:, 1])]
    share = language.mixture(grams, p)
    np.testing.assert_allclose(share[0], [2 / 3, 0, 1 / 3], atol=0.06)
    assert share[0][1] == 0 and share[1].tolist() == [0, 1, 0]


def test_learning_counts_every_labelled_text(spark):
    model = language.learn(cases.documents(spark))
    assert model.languages == ("de", "en", "fr", "ja")
    for column, lang in enumerate(model.languages):
        counts = np.full(language.BUCKETS, language.SMOOTHING)
        for _, text, own, *_ in cases.awkward():
            if text and own == lang:
                np.add.at(counts, language.trigrams(text), 1)
        np.testing.assert_allclose(model.probability[:, column], counts / counts.sum())


def test_awkward_documents(spark):
    docs = cases.documents(spark)
    found = language.identify(docs, language.learn(docs))
    assert [c for c in found.columns if c not in ("lang_pred", "score")] == [c for c in docs.columns if c != "score"]
    rows = found.collect()
    assert len(rows) == len(cases.awkward())
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 10} == {"ja"}


def test_nothing_learned_and_empty_table(spark):
    nothing = language.learn(cases.empty(spark))
    assert {r["lang_pred"] for r in language.identify(cases.documents(spark), nothing).collect()} == {"und"}
    assert language.identify(cases.empty(spark), language.learn(cases.documents(spark))).collect() == []


def test_query_is_right_on_documents_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op5_language_id"](spark, folder).collect()
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) / len(out) > 0.95


def test_labels_held_out_are_not_learned(spark):
    docs = cases.documents(spark).withColumn("doc_id", F.col("doc_id"))
    marked = language.held_out(docs)
    for r in marked.collect():
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
