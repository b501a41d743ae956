import numpy as np
import pytest

from tidewalk.llm import common, lattice, queries


def slow(rows, least=0.9):
    """vec_id, n_links, component, kept of every row by comparing all rows."""
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) if ok else None
        unit.append(None if x is None else x / np.linalg.norm(x / np.abs(x).max()) / np.abs(x).max())
    n = len(rows)
    linked = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
               and unit[i] @ unit[j] >= least] for i in range(n)]
    seen, label = set(), {}
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for j in linked[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        for j in group:
            label[j] = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
    return sorted(((r[0], len(linked[i]), label[i], r[0] is not None and r[0] == label[i]) for i, r in enumerate(rows)), key=str)


def frame(spark, rows):
    plain = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y") for i, v in rows]
    return spark.createDataFrame(plain, "vec_id long, embedding array<double>, label string, n string").repartition(3)


def result(spark, rows):
    return sorted(map(tuple, lattice.near_duplicates(frame(spark, rows)).collect()), key=str)


def near(rng, x, cosine):
    z = rng.normal(size=len(x))
    z -= z @ x / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + np.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z)


def test_decoding_gives_the_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) * 2
    points = lattice.nearest_e8(x)
    doubled = points * 2
    assert (doubled == np.rint(doubled)).all() and (points.sum(axis=1) % 2 == 0).all()
    assert ((doubled % 2 == doubled[:, :1] % 2)).all()
    around = points[:, None] + lattice.ROOTS[None]
    distance = ((x[:, None] - around) ** 2).sum(axis=2)
    assert (distance[:, 0] <= distance.min(axis=1) + 1e-12).all() and len(lattice.ROOTS) == 241


@pytest.mark.parametrize("block", [2048, 5])
def test_clusters_copies_and_unusable_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(common, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(6):
        x = rng.normal(size=64)
        rows += [near(rng, x, 0.97) for _ in range(8)] + [x, x, x]
    rows += [rng.normal(size=64) for _ in range(40)]
    rows += [None, [], np.zeros(64), [None] * 64, np.full(64, np.nan), np.full(64, np.inf), np.zeros(64), rows[0] * 3.0,
             rows[0] * 1e200, rng.normal(size=8), rng.normal(size=16)]
    numbered = [(100 - i if i != 30 else None, v) for i, v in enumerate(rows)] + [(100, rows[0]), (100, rows[0])]
    assert result(spark, numbered) == slow(numbered)


@pytest.mark.parametrize("cosine", [0.901, 0.92, 0.95])
def test_recall_against_brute_force(spark, cosine):
    rng = np.random.default_rng(int(cosine * 1000))
    rows = []
    for _ in range(300):
        x = rng.normal(size=64)
        rows += [x, near(rng, x, cosine)]
    rows = list(enumerate(rows))
    got = sum(r[1] for r in result(spark, rows))
    expected = sum(r[1] for r in slow(rows))
    assert expected == 600 and 0.95 * expected <= got <= expected


def test_nothing_below_the_bound_is_linked(spark):
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(200):
        x = rng.normal(size=64)
        rows += [x, near(rng, x, 0.899)]
    assert sum(r[1] for r in result(spark, list(enumerate(rows)))) == 0


def test_query_and_empty_table(spark, sf_dir):
    rows = sorted(map(tuple, queries.QUERIES["op8_embedding_near_dedup"](spark, sf_dir).collect()), key=str)
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert rows == slow(table)
    assert lattice.near_duplicates(frame(spark, [])).collect() == []


def test_recall_on_a_larger_table(spark):
    """The vectors of a test table with near copies of some of them, against brute force."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    rng = np.random.default_rng(5)
    rows = [(r[0], np.array(r[1], float)) for r in table]
    rows += [(10_000 + i, near(rng, rows[i % 400][1], 0.9 + 0.001 + 0.09 * rng.random())) for i in range(1200)]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    expected = dict(zip([i for i, _ in rows], ((x @ x.T >= 0.9).sum(axis=1) - 1).tolist(), strict=True))
    got = {r[0]: r[1] for r in result(spark, rows)}
    assert len(got) == len(rows) and sum(expected.values()) > 2000
    assert all(got[i] <= expected[i] for i in expected)
    assert sum(got.values()) >= 0.97 * sum(expected.values())
