"""What several operators need: ranks without hot tasks, comparison within anchors, connected components.

Intermediate tables go to the shared folder of `spark.checkpoint.dir` (`tidewalk.sources.tables.materialise`), so a
lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.sources.tables import materialise

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TEXTS_AT_ONCE = 256  # texts held as Python strings at a time
PAIRS_AT_ONCE = 1 << 21  # comparisons held in memory at a time
BLOCK = 2048  # rows of one side of one unit of comparison


def lower_ascii(column: Column) -> Column:
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def read(spark, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def slices(batches: Iterator[pa.RecordBatch], rows: int = TEXTS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches in small slices, so that few texts exist as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def materialise_with_task(frame: DataFrame, label: str) -> DataFrame:
    """Write the frame with the number of the task that wrote each row, in `_task`."""
    return materialise(frame.withColumn("_task", F.spark_partition_id()), label)


def rank_within(table: DataFrame, key: str, *order: str) -> DataFrame:
    """Add `position`: the gapless place, from 0, of a row among the rows of its key.

    `table` comes from `materialise_with_task`. Rows are numbered inside (key, task), which holds no more than one
    task's rows, and moved on by the counts of the key's earlier tasks, so no task gathers a hot key.
    """
    counts = table.groupBy(key, "_task").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(key, "_task").orderBy(*order)) - 1
    numbered = table.withColumn("_local", local).join(offsets, [key, "_task"])
    return numbered.withColumn("position", F.col("_before") + F.col("_local")).drop("_before", "_local", "_task")


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a few links and the smallest node that each is joined to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Column arrays that end where a unit ends."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        arrays = {c: table.column(c).to_numpy() for c in ("bucket", "i", "j")}
        changes = np.flatnonzero(
            (np.diff(arrays["bucket"]) != 0) | (np.diff(arrays["i"]) != 0) | (np.diff(arrays["j"]) != 0)
        )
        if len(changes):
            cut = int(changes[-1]) + 1
            yield {c: table.column(c).slice(0, cut).to_numpy() for c in table.column_names}
            rest = table.slice(cut).combine_chunks()
        else:
            rest = table.combine_chunks()
    if rest is not None:
        yield {c: rest.column(c).to_numpy() for c in rest.column_names}


def _close_pairs(rows: dict[str, np.ndarray], max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of every home and visitor of a unit whose signatures differ in few bits."""
    n = len(rows["bucket"])
    new = np.ones(n, bool)
    new[1:] = (np.diff(rows["bucket"]) != 0) | (np.diff(rows["i"]) != 0) | (np.diff(rows["j"]) != 0)
    unit = np.cumsum(new) - 1
    homes = np.bincount(unit, weights=rows["home"]).astype(np.int64)
    first = np.flatnonzero(new)
    visitors = np.flatnonzero(rows["home"] == 0)
    visitors = visitors[homes[unit[visitors]] > 0]
    each = homes[unit[visitors]]
    ends = np.cumsum(each)
    start = 0
    while start < len(visitors):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
        some, count = visitors[start:stop], each[start:stop]
        left = np.repeat(some, count)
        step = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        right = np.repeat(first[unit[some]], count) + step
        differing = np.bitwise_count((rows["sig"][left] ^ rows["sig"][right]).view(np.uint64))  # signed: of the absolute
        near = differing <= max_bits
        a, b = rows["id"][left[near]], rows["id"][right[near]]
        other = a != b
        if other.any():
            yield np.minimum(a[other], b[other]), np.maximum(a[other], b[other])
        start = stop


def close_pairs(rows: DataFrame, max_bits: int, forest: bool) -> DataFrame:
    """Links (a, b), a < b, between ids that meet in a bucket with signatures at most `max_bits` apart.

    `rows` has bucket, home (boolean), sig, id (longs): an id is at home in the bucket of its own anchor and visits
    the buckets around it, its own included. Buckets where nobody else can be met are dropped by count; that join is by
    shuffle, since Spark sizes rows made in Python by those they were made from and would broadcast them all. A bucket with
    more than `BLOCK` rows of a side is cut into blocks by id, and every pair of blocks is a unit of its own, so a hot
    bucket spreads over many tasks and none holds more than two blocks. With `forest`, links that are joined in the
    unit already are left out: a unit gives fewer links than it has rows, and the same components.
    """
    counts = rows.groupBy("bucket").agg(
        F.sum(F.col("home").cast("long")).alias("h"), F.sum((~F.col("home")).cast("long")).alias("v")
    ).where("h >= 1 AND v >= 2")
    mine, others = F.ceil(F.col("h") / BLOCK).cast("int"), F.ceil(F.col("v") / BLOCK).cast("int")
    placed = (
        rows.join(counts.hint("merge"), "bucket")
        .withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("home"), mine).otherwise(others)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("home"), others).otherwise(mine) - 1)))
        .select(
            "bucket", "sig", "id", F.col("home").cast("int").alias("home"),
            F.when(F.col("home"), F.col("own")).otherwise(F.col("other")).alias("i"),
            F.when(F.col("home"), F.col("other")).otherwise(F.col("own")).alias("j"),
        )
    )
    ordered = placed.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", F.desc("home"))

    def compare(batches):
        for unit in _units(batches):
            for a, b in _close_pairs(unit, max_bits):
                if forest:
                    nodes, tops = roots(a, b)
                    a, b = tops[nodes != tops], nodes[nodes != tops]
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return ordered.mapInArrow(compare, "a long, b long")


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest node that can be reached.

    Large-star and small-star rounds. Each round joins a node's neighbours with their minimum, which was aggregated
    map-side, and is written before the next, so lineage stays short; a hub's join partition is split by adaptive
    execution. No round gathers a neighbour list.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = small.unionByName(lower.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialise(star, label)
    tops = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(tops)
