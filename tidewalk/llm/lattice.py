"""Embedding near-duplicates by lattice hashing.

A table projects the unit vectors to 16 random directions and decodes both halves to the nearest point of the E8
lattice. A vector is at home in its own cell and visits the neighbouring cells that lie closest to its projection, the
240 shortest lattice vectors around either half being the candidates. Vectors that meet are compared by 64 random
signs, and the pairs left are verified by their cosine in double precision. Equal vectors are one class throughout.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import close_pairs, components, materialise, slices

TABLES = 6
VISITS = 12  # neighbouring cells that a vector visits in a table
SPACING = 0.3  # of the lattice, for unit vectors of 64 components; it shrinks with the root of their number
NEAR_ROOTS = 8  # neighbours of either half that are combined
# Signs that may differ: vectors with cosine 0.9 differ in 9.2 of 64 on average, standard deviation 2.8.
SIGNS_APART = 22
SEED = 20
VECTORS_AT_ONCE = 1024


def _roots() -> np.ndarray:
    """The 240 shortest vectors of the E8 lattice, after the zero vector."""
    out = [np.zeros(8)]
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            out.append(np.eye(8)[i] * a + np.eye(8)[j] * b)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of even sum."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    worst = np.abs(x - r)[odd].argmax(axis=1)
    r[odd, worst] += np.where(x[odd, worst] >= r[odd, worst], 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice points: whole coordinates of even sum, or all shifted by a half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def _cell(points: np.ndarray, table: int, size: int) -> np.ndarray:
    """A number for the cell with this lattice point (16 coordinates) in a table for vectors of this size."""
    h = np.full(len(points), (table + 1) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64) ^ np.uint64(size)
    for column in np.rint(points * 2).astype(np.int64).view(np.uint64).T:
        h = (h ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _directions(size: int):
    """For every table its projection and shift, and the directions of the signs."""
    rng = np.random.default_rng((SEED, size))
    tables = []
    for _ in range(TABLES):
        normal = rng.normal(size=(size, 16))
        basis = np.linalg.qr(normal)[0] if size >= 16 else normal / np.sqrt(size)
        tables.append((basis, rng.uniform(size=16) * 2))
    return tables, rng.normal(size=(size, 64))


def cells(unit: np.ndarray, table: int, basis: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The home cell (first column) and the visited cells, the home included, of unit vectors."""
    x = unit @ basis / (SPACING * 8 / np.sqrt(unit.shape[1])) + shift
    homes, costs, order = [], [], []
    for half in (x[:, :8], x[:, 8:]):
        home = nearest_e8(half)
        cost = (ROOTS ** 2).sum(axis=1) - 2 * (half - home) @ ROOTS.T
        near = np.argsort(cost, axis=1, kind="stable")[:, : NEAR_ROOTS + 1]
        homes.append(home)
        order.append(near)
        costs.append(np.take_along_axis(cost, near, axis=1))
    both = (costs[0][:, :, None] + costs[1][:, None, :]).reshape(len(x), -1)
    chosen = np.argsort(both, axis=1, kind="stable")[:, : VISITS + 1]
    out = [_cell(np.hstack(homes), table, unit.shape[1])]
    for k in range(VISITS + 1):
        first, second = np.divmod(chosen[:, k], NEAR_ROOTS + 1)
        steps = [ROOTS[np.take_along_axis(near, at[:, None], axis=1)[:, 0]] for near, at in zip(order, (first, second))]
        out.append(_cell(np.hstack([homes[0] + steps[0], homes[1] + steps[1]]), table, unit.shape[1]))
    return np.column_stack(out)


def _usable(values) -> np.ndarray | None:
    """The vector in double precision, its largest component 1; None if it is null, zero or not finite."""
    if values is None or not len(values) or None in values:
        return None
    vector = np.array(values, np.float64)
    top = np.abs(vector).max()
    if not np.isfinite(vector).all() or top == 0:
        return None
    return vector / top + 0.0


def vectors(table: DataFrame) -> DataFrame:
    """vec_id and the vector's doubles as bytes, null for vectors that link with nothing."""

    def pack(batches):
        for batch in slices(batches):
            usable = [_usable(v) for v in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"),
                "vec": pa.array([None if v is None else v.tobytes() for v in usable], pa.binary()),
            })

    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(pack, "vec_id long, vec binary")


def _by_size(batches, column: str, rows: int):
    """Slices of a batch as (batch, matrix of the vectors), one for every size of vector."""
    for batch in slices(batches, rows):
        data = batch.column(column).to_pylist()
        for size in sorted({len(v) for v in data}):
            at = [i for i, v in enumerate(data) if len(v) == size]
            yield batch.take(pa.array(at)), np.frombuffer(b"".join(data[i] for i in at)).reshape(len(at), -1)


def hashed(classes: DataFrame) -> DataFrame:
    """The classes (cid, vec) at home and in the cells they visit, as `close_pairs` takes them."""

    def replicate(batches):
        known = {}
        for batch, matrix in _by_size(batches, "vec", VECTORS_AT_ONCE):
            size = matrix.shape[1]
            tables, signs = known.setdefault(size, _directions(size))
            unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
            sig = np.packbits(unit @ signs > 0, axis=1, bitorder="little").view("<i8")[:, 0]
            ids = batch.column("cid").to_numpy()
            for number, (basis, shift) in enumerate(tables):
                found = cells(unit, number, basis, shift)
                yield pa.RecordBatch.from_pydict({
                    "bucket": found.T.ravel(), "home": np.arange(found.size) < len(ids),
                    "sig": np.tile(sig, found.shape[1]), "id": np.tile(ids, found.shape[1]),
                })

    return classes.select("cid", "vec").mapInArrow(replicate, "bucket long, home boolean, sig long, id long")


def verified(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of classes with a cosine of at least `least`, with the numbers of copies na and nb."""

    def verify(batches):
        for batch in slices(batches, VECTORS_AT_ONCE):
            a, b = batch.column("va").to_pylist(), batch.column("vb").to_pylist()
            keep = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x), np.frombuffer(y)
                keep.append(len(x) == len(y) and float(x @ y / np.sqrt((x @ x) * (y @ y))) >= least)
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "na", "nb"])

    left = classes.select(F.col("cid").alias("a"), F.col("vec").alias("va"), F.col("n").alias("na"))
    right = classes.select(F.col("cid").alias("b"), F.col("vec").alias("vb"), F.col("n").alias("nb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "va", "vb")
    return joined.mapInArrow(verify, "a long, b long, na long, nb long")


def near_duplicates(table: DataFrame, least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector, over all vectors.

    A link is a cosine of at least `least`; copies are linked with each other, once per row, and vectors of different
    sizes are not. Vectors that are null, empty, zero or hold null or non-finite components have no links. component_id
    is the smallest vec_id that links reach, null ids last. Repeated rows stay. An empty table gives none.
    """
    rows = materialise(vectors(table), "vectors")
    grouped = rows.where("vec IS NOT NULL").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = materialise(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    pairs = close_pairs(hashed(classes), SIGNS_APART, forest=False).distinct()
    links = materialise(verified(pairs, classes, least), "links")
    ends = links.select(F.col("a").alias("cid"), F.col("nb").alias("n")).unionByName(
        links.select(F.col("b").alias("cid"), F.col("na").alias("n"))
    )
    others = ends.groupBy("cid").agg(F.sum("n").alias("others"))
    tops = components(links.select("a", "b"), "lattice").select(F.col("node").alias("cid"), "root")
    named = classes.join(others, "cid", "left").join(tops, "cid", "left").select(
        "vec", "least", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "cid").alias("root")
    )
    named = materialise(named, "vector-links")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(smallest, "root").select("vec", "n_links", "component_id")
    joined = rows.join(known, "vec", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
