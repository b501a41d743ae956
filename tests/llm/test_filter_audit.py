import re
from collections import Counter
from itertools import permutations

import cases
import pytest

from tidewalk.llm import filter_audit

ORDERS = ["".join(p) for p in permutations("ABCDE")]


def plain_masks(documents):
    """(part, failed letters) per row by the definitions."""
    smaller = {}
    for doc, text, _ in documents:
        if doc is not None:
            smaller[text or ""] = min(doc, smaller.get(text or "", doc))
    for doc, text, lang in documents:
        text = text or ""
        words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
        failed = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and doc > smaller.get(text, doc),
        }
        yield lang or "", frozenset(letter for letter, fails in failed.items() if fails)


def plain_audit(documents, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    masks = list(zip(documents, plain_masks(documents)))
    out, values = {}, Counter()
    for (doc, _, _), (part, failed) in masks:
        for order in ORDERS:
            there = True
            for step, letter in enumerate(order, 1):
                row = out.setdefault((part, order, step), Counter())
                row["kept"] += there and letter not in failed
                removed = there and letter in failed
                row["removed"] += removed
                row["redundant"] += not there and letter in failed
                row["unique_fails"] += failed == {letter}
                row["good_lost"] += removed and doc in good
                row["toxic_lost"] += removed and doc in toxic
                values[part, letter] += removed
                there = there and letter not in failed
    return sorted(
        (part, order, step, *[row[c] for c in filter_audit.COUNTS], values[part, order[step - 1]])
        for (part, order, step), row in out.items()
    )


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, lang string").repartition(2)


LABELS = [(4, 1, 0, "x"), (5, 0, 1, "x"), (5, 1, None, "x"), (6, None, 1, "x"), (None, 1, 1, "x"), (999, 1, 1, "x"), (7, 1, 1, None)]


def rows_of(frame):
    assert frame.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    return sorted(tuple(r) for r in frame.collect())


def test_awkward_documents(spark):
    rows = cases.awkward() + [
        (200 + i, " ".join(f"Word{j}" for j in range(60 * i)) + " $" * (i % 2), ["en", None, ""][i % 3], "d", 1) for i in range(9)
    ] + [(300 + i, ["SHOUT ing", "#", ""][i % 3], "en", "d", 1) for i in range(9)]
    found = rows_of(filter_audit.audit(cases.documents(spark, rows), labels(spark, LABELS)))
    expected = plain_audit([(r[0], r[1], r[2]) for r in rows], [r[:3] for r in LABELS])
    assert found == expected and {r[0] for r in found} >= {"", "en", "ja"}


def test_a_text_that_a_third_of_all_rows_share(spark):
    rows = [(i, "same #" if i % 3 == 0 else f"text {i}", ["en", "fr"][i % 2], "s", 1) for i in range(300)]
    found = rows_of(filter_audit.audit(cases.documents(spark, rows, 9), labels(spark, [(0, 1, 0, ""), (3, 1, 0, "")])))
    assert found == plain_audit([(r[0], r[1], r[2]) for r in rows], [(0, 1, 0), (3, 1, 0)])
    assert len(found) == 2 * 600


@pytest.mark.parametrize("documents, tags", [([], LABELS), (cases.awkward()[:3], [])])
def test_empty_tables(spark, documents, tags):
    found = rows_of(filter_audit.audit(cases.documents(spark, documents), labels(spark, tags)))
    assert found == plain_audit([(r[0], r[1], r[2]) for r in documents], [r[:3] for r in tags])
