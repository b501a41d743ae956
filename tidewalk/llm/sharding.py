"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts enter shards largest first, each into the shard with the least remaining capacity that holds it,
found in a balanced tree. Groups of one size are interchangeable, so the packer works on counts per size class: sizes
up to 2,048 are exact, larger ones are rounded up to 11 significant bits (less than 0.1 %). There are at most 2,048
classes and 1,024 per doubling beyond, some 45,000 for sizes up to 2^53, whatever the corpus. Groups take their places
by their rank in the class.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidewalk.llm.common import materialise, materialise_with_task, rank_within

SIGNIFICANT_BITS = 11
TOLERANCE = 1e-4  # how far above the smallest capacity the search may end
RANKS = 1 << 48  # more than there are groups of one class


class CapacityTree:
    """A treap of (remaining capacity, shard): insertion, removal and the tightest fit take logarithmic time."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return hash((key[1], key[0], 0x9E3779B97F4A7C15))

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return (a[0], a[1], a[2], self._merge(a[3], b))
        return (b[0], b[1], self._merge(a, b[2]), b[3])

    def _split(self, node, key):
        """Nodes below the key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return (node[0], node[1], node[2], low), high
        low, high = self._split(node[2], key)
        return low, (node[0], node[1], high, node[3])

    def add(self, remaining: int, shard: int) -> None:
        key = (remaining, shard)
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, (key, self._priority(key), None, None)), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the shard with the least remaining capacity that holds the size."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            return None
        least = high
        while least[2] is not None:
            least = least[2]
        _, rest = self._split(high, (least[0][0], least[0][1] + 1))
        self.root = self._merge(low, rest)
        return least[0]


@dataclass(frozen=True)
class Run:
    """`count` groups of one size class, from a rank on, in one shard."""

    size: int
    first: int
    count: int
    shard: int


def best_fit_decreasing(classes: dict[int, int], capacity: int, most: int | None = None) -> list[Run] | None:
    """Fill shards of the capacity from counts per size; a larger group gets a shard of its own.

    None if more than `most` shards would be opened.
    """
    tree, runs, opened = CapacityTree(), [], 0
    for size in sorted(classes, reverse=True):
        rank, left = 0, classes[size]
        while left:
            fit = tree.take_tightest(size)
            if fit is None:
                if most is not None and opened == most:
                    return None
                fit, opened = (max(capacity, size), opened), opened + 1
            count = min(left, fit[0] // size)
            runs.append(Run(size, rank, count, fit[1]))
            tree.add(fit[0] - count * size, fit[1])
            rank, left = rank + count, left - count
    return runs


def into_shards(classes: dict[int, int], shards: int) -> list[Run]:
    """Fill a given number of shards as equally as groups allow, by the smallest capacity that suffices.

    A group above an equal part of what is left gets a shard of its own; the others share the rest.
    """
    left, alone = dict(classes), []
    total = sum(size * n for size, n in left.items())
    while left and shards - len(alone) > 1:
        largest = max(left)
        if largest * (shards - len(alone)) <= total:
            break
        alone.append(Run(largest, classes[largest] - left[largest], 1, shards - 1 - len(alone)))
        total -= largest
        left[largest] -= 1
        left = {size: n for size, n in left.items() if n}
    if not left:
        return alone
    bins = shards - len(alone)
    low, high = -(-total // bins), -(-total // bins) + max(left)
    best = best_fit_decreasing(left, high, bins)
    while high - low > max(0, int(low * TOLERANCE)):
        middle = (low + high) // 2
        if runs := best_fit_decreasing(left, middle, bins):
            best, high = runs, middle
        else:
            low = middle + 1
    before = {run.size: 0 for run in alone}
    for run in alone:
        before[run.size] += 1
    return alone + [Run(r.size, r.first + before.get(r.size, 0), r.count, r.shard) for r in best]


def size_class(name: str) -> Column:
    """The size in this column, or the next larger one with 11 significant bits."""
    step = f"shiftleft(1L, greatest(length(bin({name})) - {SIGNIFICANT_BITS}, 0))"
    return F.expr(f"({name} + {step} - 1) div {step} * {step}")


def assign(documents: DataFrame, shards: int) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32 (unsigned), shard and slot, gapless from 0 in each shard.

    Equal texts are one group, null texts another of size 1 each with crc 0; a group is never divided, so a shard that
    holds a group above an equal part is larger. Sizes of the others differ by what rounding and the last groups
    leave. Repeated rows and ids stay. An empty table gives none.
    """
    text = F.col("text").cast("string")
    rows = materialise_with_task(
        documents.select(
            "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(text, 256)), F.expr("x''")).alias("_group"),
        ),
        "sizes",
    )
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_weight"))
    groups = materialise_with_task(groups.withColumn("_class", size_class("_weight")), "groups")
    classes = {r["_class"]: r["n"] for r in groups.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = sorted(into_shards(classes, shards), key=lambda r: (r.size, r.first))
    starts = [r.size * RANKS + r.first for r in runs]
    numbers = np.array([r.shard for r in runs], np.int32)

    @pandas_udf("int")
    def place(size: pd.Series, rank: pd.Series) -> pd.Series:
        keys = size.to_numpy().astype(object) * RANKS + rank.to_numpy().astype(object)
        return pd.Series(numbers[[bisect_right(starts, k) - 1 for k in keys]])

    placed = rank_within(groups, "_class", "_group").select("_group", place("_class", "position").alias("shard"))
    # a text that many rows share meets its shard once per task that read it, and its rows there
    met = rows.select("_group", "_task").distinct().join(placed, "_group")
    dealt = materialise(rows.join(met, ["_group", "_task"]), "shards")
    return rank_within(dealt, "shard", "doc_id", "size", "text_crc32", "_group").select(
        "doc_id", "size", "text_crc32", "shard", F.col("position").cast("long").alias("slot")
    )
