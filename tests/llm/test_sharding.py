import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

import cases
import pytest
from tidewalk.llm import queries, sharding


def slow_best_fit(classes, capacity):
    """Loads of the shards by the plain rule, one group at a time."""
    loads = []
    for size in sorted(classes, reverse=True):
        for _ in range(classes[size]):
            fits = [i for i, (load, room) in enumerate(loads) if load + size <= room]
            if fits:
                best = min(fits, key=lambda i: (loads[i][1] - loads[i][0], i))
                loads[best][0] += size
            else:
                loads.append([size, max(capacity, size)])
    return [load for load, _ in loads]


def loads(runs):
    out = defaultdict(int)
    for run in runs:
        out[run.shard] += run.size * run.count
    return [out[i] for i in range(len(out))]


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=15), st.integers(10, 80))
@settings(max_examples=200, deadline=None)
def test_runs_are_the_plain_best_fit(classes, capacity):
    assert loads(sharding.best_fit_decreasing(classes, capacity)) == slow_best_fit(classes, capacity)


@given(st.dictionaries(st.integers(1, 5000), st.integers(1, 40), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_every_group_has_one_place(classes):
    runs = sharding.into_shards(classes, 16)
    for size, n in classes.items():
        ranks = sorted(r for run in runs if run.size == size for r in range(run.first, run.first + run.count))
        assert ranks == list(range(n))
    assert {run.shard for run in runs} <= set(range(16))


def test_size_classes(spark):
    sizes = [1, 2047, 2048, 2049, 4095, 4097, 123_456_789, (1 << 52) + 1]
    frame = spark.createDataFrame([(s,) for s in sizes], "w long").select("w", sharding.size_class("w").alias("c"))
    for w, c in frame.collect():
        assert w <= c <= w * 1.001 and (w > 2048 or w == c)


def held(rows, texts, shards):
    expected = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_text = defaultdict(set)
    for r in rows:
        by_text[r["size"], r["text_crc32"]].add(r["shard"])
    return by_text


def test_awkward_documents(spark):
    rows = sharding.assign(cases.documents(spark), 4).collect()
    groups = held(rows, [(r[0], r[1]) for r in cases.awkward()], 4)
    assert all(len(s) == 1 for (size, _), s in groups.items() if size > 1)  # null and empty texts are two groups
    assert sharding.assign(cases.empty(spark), 4).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_deals_equal_bytes(spark, folder):
    rows = queries.QUERIES["op9_sharding"](spark, folder).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert all(len(s) == 1 for s in held(rows, texts, 16).values())
    size = Counter()
    for r in rows:
        size[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
    groups = Counter()
    for _, text in texts:
        groups[text] += len(text.encode()) + 1
    mean = sum(size.values()) / 16
    assert len(size) == 16 and max(size.values()) <= max(mean * 1.01, max(groups.values()) * 1.001)
    if max(groups.values()) <= mean:
        assert min(size.values()) >= mean * 0.95
