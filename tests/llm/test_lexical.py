import math
import random
import re
from collections import Counter

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewalk.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain_search(documents, items, k):
    """The contract's formula over all documents."""
    found = [(doc, Counter(plain_terms(text))) for doc, text in documents]
    found = [(doc, terms) for doc, terms in found if terms]
    n_docs, words = len(found), sum(t.total() for _, t in found)
    df = Counter(term for _, terms in found for term in terms)
    out = []
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(plain_terms(text))
    for item, terms in asked.items():
        scores = []
        for doc, own in found:
            m, score = 25 + (75 * own.total() * n_docs) // words, 0
            for term, times in terms.items():
                if term in own:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * ((10**9 * own[term]) // (1000 * own[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


@given(st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 6)), max_size=40), min_size=1, max_size=6),
       st.lists(st.integers(1, 3), min_size=6, max_size=6), st.integers(1, 5), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_best_documents_of_a_segment(lists, times, k, first_read):
    """Bounds and ties: small integers make many equal scores, small reads many rounds."""
    lists = [dict(pairs) for pairs in lists]
    docs = np.array([d for one in lists for d in one], np.int64)
    terms = np.array([t for t, one in enumerate(lists) for _ in one], np.int64)
    impacts = np.array([i for one in lists for i in one.values()], np.int64)
    ids = np.arange(31)[::-1] * 10
    segment = lexical.Segment(ids, docs, terms, impacts, len(lists))
    query = lexical.Query(1, np.arange(len(lists)), np.array(times[:len(lists)]))
    before, lexical.FIRST_READ = lexical.FIRST_READ, first_read
    try:
        best, scores = segment.best(query, k)
    finally:
        lexical.FIRST_READ = before
    totals = Counter()
    for t, one in enumerate(lists):
        for doc, impact in one.items():
            totals[doc] += impact * times[t]
    expected = sorted(((-s, ids[d]) for d, s in totals.items() if s > 0))[:k]
    assert [(-s, ids[d]) for d, s in zip(best, scores)] == expected


def table(spark, rows, names):
    return spark.createDataFrame(rows, names).repartition(3)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("at_once, postings", [(200_000, 2_000_000), (5, 40)])
def test_awkward_documents_and_items(spark, monkeypatch, at_once, postings):
    """Also with many item blocks over one index of all terms, and many segments."""
    monkeypatch.setattr(lexical, "TERMS_AT_ONCE", at_once)
    monkeypatch.setattr(lexical, "SEGMENT_POSTINGS", postings)
    rng = random.Random(3)
    items = [(i, cases.prose(rng.randrange(70), 8)) for i in range(12)]
    items += [(3, "the of"), (None, "Maison house"), (None, "THING"), (20, None), (21, ""), (22, "日本語 é word"), (23, "nowhere")]
    found = lexical.search(cases.documents(spark), table(spark, items, "item_id long, text string"), 10)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert result(found) == plain_search([(r[0], r[1]) for r in cases.awkward()], items, 10)


def test_long_texts_are_split_whole(monkeypatch):
    monkeypatch.setattr(lexical, "BYTES_AT_ONCE", 7)
    for text in [cases.prose(5, 300), "x" * 100 + " é日 " * 9, "", " ", "abc" * 50, "a b " * 30]:
        assert lexical.term_counts(text) == Counter(t.encode() for t in plain_terms(text))


def test_empty_tables(spark):
    items = table(spark, [(1, "word two")], "item_id long, text string")
    assert lexical.search(cases.empty(spark), items).collect() == []
    assert lexical.search(cases.documents(spark), items.limit(0)).collect() == []
    assert lexical.search(cases.documents(spark, [(1, " ", "en", "a", 1)]), items).collect() == []


def test_hot_term_and_equal_texts(spark):
    rows = [(i, "the house" if i % 3 else f"the river {i}", "en", "a", 1) for i in range(600)]
    items = [(1, "the house"), (2, "the the river 30")]
    found = result(lexical.search(cases.documents(spark, rows), table(spark, items, "item_id long, text string"), 10))
    assert found == plain_search([(r[0], r[1]) for r in rows], items, 10)
