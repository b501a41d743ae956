"""Boosted trees with penalties on their leaf values, round by round on Spark ML's single trees.

Spark ML's boosting has no such penalties, and they cannot be added afterwards, since a round fits what the rounds
before it left. Here every round fits one tree to the residuals, sets each leaf's value from the residuals' sum and
count in it, one aggregation by leaf, and writes the new residuals before the next. A round is a dozen jobs, so this is
for a final fit; a whole cross-validation stays with Spark ML. The fitted trees are a table of nodes
(`operators.tree_tables`).
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewalk.config import TARGET
from tidewalk.operators.tree_tables import LEAF
from tidewalk.sources import tables

BUCKETS = 1 << 20  # of the hash that draws a round's rows


@dataclass(frozen=True)
class Boosting:
    """Settings of a fit; the defaults are the published ones with penalties (fixed values)."""

    rounds: int = 300
    depth: int = 4
    step: float = 0.03
    l1: float = 0.5
    l2: float = 1.0
    row_share: float = 0.8
    column_share: float = 0.8
    least_rows: int = 1
    bins: int = 256
    seed: int = 42


def leaf_value(total: Column, n: Column, l1: float, l2: float) -> Column:
    """The value w that minimises sum (r - w)^2 / 2 + l1 |w| + l2 w^2 / 2 over n residuals r with this sum."""
    return F.signum(total) * F.greatest(F.abs(total) - l1, F.lit(0.0)) / (n + l2)


def _drawn(keys: Sequence[str], number: int, settings: Boosting) -> Column:
    """Whether a row takes part in a round: by a hash of its key, so a repeated task draws the same rows."""
    drawn = F.pmod(F.xxhash64(*keys, F.lit(settings.seed), F.lit(number)), F.lit(BUCKETS))
    return drawn < int(settings.row_share * BUCKETS)


def _columns(n: int, number: int, settings: Boosting) -> list[int]:
    chosen = random.Random(settings.seed * 1_000_003 + number).sample(range(n), max(1, int(n * settings.column_share)))
    return sorted(chosen)


def fit_boosted(
    frame: DataFrame, feature_cols: Sequence[str], keys: Sequence[str], settings: Boosting = Boosting(),
    label: str = TARGET, rows_per_task: int = 20_000,
) -> DataFrame:
    """The node table of a fit to complete rows (keys, features, label).

    The label's mean is a tree of one leaf with weight 1; every round is a tree with the step as weight. Residuals are
    held in files between rounds, so lineage stays short and a lost executor costs a re-read. Rows without a label, or
    none at all, are an error.
    """
    spark = frame.sparkSession
    assembled = VectorAssembler(inputCols=list(feature_cols), outputCol="features").transform(frame)
    rows = tables.materialise(assembled.select(*keys, "features", F.col(label).cast("double").alias("residual")), "boosting")
    n, mean = rows.agg(F.count(F.lit(1)), F.avg("residual")).first()
    if not n:
        raise ValueError("no rows to fit")
    rows = rows.coalesce(max(1, n // rows_per_task)).withColumn("residual", F.col("residual") - F.lit(mean))
    folder, fitted = tables.new_working_path(spark, "boosted-trees"), []
    for number in range(settings.rounds):
        chosen = _columns(len(feature_cols), number, settings)
        sliced = VectorSlicer(inputCol="features", outputCol="chosen", indices=chosen).transform(rows)
        tree = DecisionTreeRegressor(
            featuresCol="chosen", labelCol="residual", predictionCol="_mean", leafCol="_leaf", maxDepth=settings.depth,
            maxBins=settings.bins, minInstancesPerNode=settings.least_rows, seed=settings.seed,
        ).fit(sliced.where(_drawn(keys, number, settings)))
        placed = tree.transform(sliced)
        sums = placed.where(_drawn(keys, number, settings)).groupBy("_leaf").agg(
            F.sum("residual").alias("total"), F.count(F.lit(1)).alias("n")
        )
        # at most 2^depth leaves
        found = sums.select("_leaf", leaf_value(F.col("total"), F.col("n"), settings.l1, settings.l2).alias("value")).collect()
        values = {int(row["_leaf"]): row["value"] for row in found}
        tree.write().save(f"{folder}/{number}")
        fitted.append((chosen, values))
        of_leaf = F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("_leaf").cast("int"))
        left = F.col("residual") - settings.step * F.coalesce(of_leaf, F.lit(0.0))
        if number + 1 < settings.rounds:
            rows = tables.materialise(placed.select(*keys, "features", left.alias("residual")), "boosting")
    return _as_nodes(frame, folder, fitted, settings, mean)


def _as_nodes(frame: DataFrame, folder: str, fitted: list[tuple], settings: Boosting, mean: float) -> DataFrame:
    """The saved trees with their own leaf values. Leaves are numbered as they come in the order of node ids."""
    spark, rows = frame.sparkSession, []
    for number, (chosen, values) in enumerate(fitted):
        saved = spark.read.parquet(f"{folder}/{number}/data").select("id", "leftChild", "rightChild", "split")
        nodes = saved.orderBy("id").collect()  # fewer than 2^(depth + 1)
        leaves = {node.id: place for place, node in enumerate(n for n in nodes if n.leftChild == LEAF)}
        for node in nodes:
            inner = node.leftChild != LEAF
            rows.append((
                number, settings.step, node.id, chosen[node.split.featureIndex] if inner else None,
                node.split.leftCategoriesOrThreshold[0] if inner else None, node.leftChild, node.rightChild,
                0.0 if inner else float(values.get(leaves[node.id], 0.0)),
            ))
    rows.append((len(fitted), 1.0, 0, None, None, LEAF, LEAF, mean))
    return spark.createDataFrame(
        rows, "tree int, weight double, node int, feature int, threshold double, left int, right int, value double"
    )
