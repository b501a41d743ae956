"""Fitted tree ensembles as a table of nodes, and scoring by descending it in joins.

A second way from a fitted model to its predictions, which uses nothing of the model but its saved nodes: it audits the
scorer, and lets a model be looked at and joined as data. It costs a row per row and tree, so the model's own
`transform` stays the way for serving.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.functions.numeric import round_f
from tidewalk.sources import tables

LEAF = -1


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(tree, weight, node, feature, threshold, left, right, value) of the ensemble that ends a pipeline, as it is saved.

    The root is node 0; a leaf has no feature, and children `LEAF`. `weight` is what a tree's value counts in the
    prediction: equal shares in a forest, the step size of a boosted tree.
    """
    ensemble = model.stages[-1]
    folder = tables.new_working_path(spark, "ensemble")
    ensemble.write().save(folder)
    shares = len(ensemble.treeWeights) if isinstance(ensemble, RandomForestRegressionModel) else 1.0
    weights = spark.createDataFrame(
        [(tree, float(weight) / shares) for tree, weight in enumerate(ensemble.treeWeights)], "tree int, weight double"
    )
    nodes = spark.read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") != LEAF
    return nodes.join(weights, "tree").select(
        "tree", "weight", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("prediction").alias("value"),
    )


def score_by_nodes(rows: DataFrame, nodes: DataFrame, feature_cols: Sequence[str], keys: Sequence[str], levels: int) -> DataFrame:
    """(keys, prediction) of complete rows: a row enters every tree at its root and goes down one level per join.

    `levels` is the depth that the trees may have; a row that is at no leaf then has no value of that tree.
    """
    trees = nodes.agg(F.max("tree")).first()[0]
    at = rows.select(
        *keys, F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("values"),
        F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("tree"), F.lit(0).alias("node"),
    )
    inner = nodes.select("tree", "node", "feature", "threshold", "left", "right")
    below = F.when(F.get("values", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
    for _ in range(levels):
        at = at.join(inner, ["tree", "node"]).select(
            *keys, "values", "tree", F.when(F.col("left") == LEAF, F.col("node")).otherwise(below).alias("node")
        )
    leaves = nodes.where(F.col("left") == LEAF).select("tree", "node", (F.col("weight") * F.col("value")).alias("part"))
    return at.join(leaves, ["tree", "node"]).groupBy(*keys).agg(F.sum("part").alias("prediction"))


def scoring_difference(scored: DataFrame, by_nodes: DataFrame, keys: Sequence[str], places: int = 9) -> DataFrame:
    """Scored rows with how far the two ways of scoring are apart instead of the prediction; null if one has no score."""
    own = by_nodes.select(*keys, F.col("prediction").alias("_by_nodes"))
    apart = round_f(F.abs(F.col("prediction") - F.col("_by_nodes")), places)
    return scored.join(own, list(keys), "left").select(
        *[c for c in scored.columns if c != "prediction"], apart.alias("difference")
    ).drop("_by_nodes")
