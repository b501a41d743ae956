import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

import cases
from tidewalk.llm import common, queries, simhash
from tidewalk.sources import tables


def slow_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i: i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def slow_components(rows):
    """doc_id and fingerprint of rows -> smallest id of the component of each row."""
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[top(i)].append(doc_id)
    return [min((d for d in groups[top(i)] if d is not None), default=None) for i in range(len(rows))]


def held(result, texts):
    prints = [(d, slow_fingerprint(t)) for d, t in texts]
    expected = sorted(
        ((d, f"{f:016x}", c) for (d, f), c in zip(prints, slow_components(prints), strict=True)), key=str
    )
    assert sorted(((r[0], r[1], r[2]) for r in result), key=str) == expected


def test_awkward_documents(spark):
    held(simhash.near_duplicates(cases.documents(spark)).collect(), [(r[0], r[1]) for r in cases.awkward()])


def test_query_against_brute_force(spark, sf_dir):
    result = queries.QUERIES["op2_simhash_near_dedup"](spark, sf_dir).collect()
    held(result, [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()])


def test_every_half_meets_every_other_within_one_bit():
    masks, count = simhash.covering_masks()
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 31, 500)
    home = words ^ masks[simhash.syndromes(words)][:, 0]
    assert (simhash.syndromes(home) == 0).all() and (np.bitwise_count(home ^ words) <= 1).all()
    for bit in range(31):
        other = words ^ (1 << bit)
        s = simhash.syndromes(other)
        near = (other[:, None] ^ masks[s] == home[:, None]) & (np.arange(16) < count[s][:, None])
        assert near.any(axis=1).all()


def fps_frame(spark, fps):
    return spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")


@pytest.mark.parametrize("block", [2048, 7])
def test_links_of_planted_fingerprints(spark, monkeypatch, block):
    """Clusters around few centres, with up to three bits flipped; a small block cuts the hot buckets."""
    monkeypatch.setattr(common, "BLOCK", block)
    rng = random.Random(5)
    fps = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(40):
            f = centre
            for _ in range(rng.randrange(5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(200)} | {0, 1, (1 << 64) - 1}
    fps = sorted(fps)
    signed = {(f - (1 << 64) if f >> 63 else f): f for f in fps}
    pairs = common.close_pairs(simhash.anchored(fps_frame(spark, fps)), 3, forest=False).distinct().collect()
    found = {frozenset((signed[r["a"]], signed[r["b"]])) for r in pairs}
    expected = {frozenset((x, y)) for i, x in enumerate(fps) for y in fps[:i] if (x ^ y).bit_count() <= 3}
    assert found == expected
    tops = {signed[r["fp"]]: r["root"] for r in simhash.groups(fps_frame(spark, fps), 3).collect()}
    least = slow_components([(i, f) for i, f in enumerate(fps)])
    by_root, by_least = defaultdict(set), defaultdict(set)
    for i, f in enumerate(fps):
        by_root[tops[f]].add(f)
        by_least[least[i]].add(f)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_least.values()))


def test_rows_at_their_anchors_are_not_broadcast(spark):
    """34 rows are made of each fingerprint, and Spark sizes them as two: their joins are by shuffle at any size."""
    prints = tables.materialise(fps_frame(spark, range(0, 1 << 40, 1 << 31)), "test-prints")
    pairs = common.close_pairs(simhash.anchored(prints), 3, forest=True)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_documents_are_not_broadcast_to_their_groups(spark):
    """Many copies of few texts are a small file of very many rows: it is never the side that is held in memory."""
    rows = [(7, "the same three words", "en", "a", 1)] * 5_000 + [(i, cases.prose(i, 20), "en", "a", 1) for i in range(400)]
    found = simhash.near_duplicates(cases.documents(spark, rows, partitions=1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and found.count() == 5_400


def test_groups_of_documents_meet_their_smallest_rows_by_shuffle(spark):
    """Both sides have a row for every fingerprint, however small the files they are sized by."""
    kept = simhash.deduplicate(cases.documents(spark))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[fp#\d+L\], \[fp#\d+L\], Inner", plan)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame([*chain, *hub, (5, 5)], "a long, b long")
    tops = {r["node"]: r["root"] for r in common.components(links, "test").collect()}
    assert tops == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(300)}


def test_deduplicate_keeps_one_of_each_group(spark):
    docs = cases.documents(spark)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    texts = [(r[0], r[1]) for r in cases.awkward()]
    prints = [(d, slow_fingerprint(t)) for d, t in texts]
    components = slow_components(prints)
    assert len(rows) == len(set(components))
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == sorted(c for c in set(components) if c is not None)


def test_empty_table(spark):
    assert simhash.near_duplicates(cases.empty(spark)).collect() == []
    assert simhash.deduplicate(cases.empty(spark)).collect() == []


def test_farther_thresholds_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_duplicates(cases.documents(spark), max_bits=4)
