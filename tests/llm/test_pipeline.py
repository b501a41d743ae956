"""The pipeline's stages against plain implementations of each decision."""

from collections import Counter

import cases
import corpus_pipeline
import pytest
import test_packing
import test_secrets
import test_simhash
from __spark_entry__ import queries
from tidewalk.llm import language


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus with copies, a leak, a secret, an unknown language and nulls."""
    root = str(tmp_path_factory.mktemp("corpus"))
    item = "the quick grey heron waited beside seven quiet ponds until the evening rain had ended"
    rows = [(i, cases.prose(i, 80), ["en", "fr", "de"][i % 3], "s", 0) for i in range(40)]
    rows += [(100 + i, cases.prose(3, 80), "en", "s", 0) for i in range(5)]
    rows += [(200, cases.prose(50, 40) + " " + item + " " + cases.prose(51, 40), "en", "s", 0)]
    rows += [(201, cases.prose(52, 40) + " token = x9Kq2LmZ7pR4tVw8YbN3 " + cases.prose(53, 40), "en", "s", 0)]
    rows += [(300, None, None, None, None), (301, "12 34 ###", "en", "s", 1), (None, cases.prose(60, 70), "en", "s", 2)]
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_every_stage_decides_as_the_plain_rules_do(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing"]

    known = stages["language_id"](spark, docs, folder)
    assert known.columns == columns
    model = language.learn(language.held_out(docs).where("NOT held_out"))
    expected = []
    for r in docs.collect():
        names, scores = model.predict([r["text"]])
        if names[0] != "und" and scores[0] >= corpus_pipeline.LEAST_SHARE:
            expected.append(tuple(r))
    assert Counter(map(tuple, known.collect())) == Counter(expected)
    assert not {300, 301} & {r["doc_id"] for r in known.collect()}

    known = known.cache()
    single = stages["simhash_near_dedup"](spark, known, folder).cache()
    texts = [(r["doc_id"], r["text"]) for r in known.collect()]
    prints = [(d, test_simhash.slow_fingerprint(t)) for d, t in texts]
    assert single.columns == columns
    assert Counter(r["doc_id"] for r in single.collect()) == Counter(set(test_simhash.slow_components(prints)))

    clean = stages["benchmark_decontamination"](spark, single, folder).cache()
    assert clean.columns == columns
    assert Counter(map(tuple, clean.collect())) == Counter(tuple(r) for r in single.collect() if r["doc_id"] != 200)

    masked = stages["secret_scans"](spark, clean, folder).cache()
    assert masked.columns == columns and masked.count() == clean.count()
    assert all(not test_secrets.slow_base(r["text"]) for r in masked.collect())

    rows = stages["best_fit_packing"](spark, masked, folder).collect()
    used, least = test_packing.check(rows, [(r["doc_id"], r["text"]) for r in masked.collect()], 2048)
    assert used <= least + 1


def test_run_and_the_registered_query(spark, folder):
    rows = queries()["pipeline"](spark, folder).collect()
    assert 3 in {r["doc_id"] for r in rows} and not {100, 200, 300, 301} & {r["doc_id"] for r in rows}
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], cases.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
