"""Ranking experiments, choosing a winner, the promotion gate and the model registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.config import ARCHIVED, PRODUCTION, REGISTERED_MODEL_NAME, GateSettings

EXPERIMENT = ("model_name", "feature_variant")
# Columns of the metrics report.
REPORT = ("mean_ic_pearson", "positive_fold_pct", "ic_t_stat", "n_folds", "meets_threshold")


def experiment_key() -> Column:
    return F.concat_ws("__", *EXPERIMENT)


def experiment_grid(folds: DataFrame, models: Sequence[str], variants: Sequence[str]) -> DataFrame:
    """One row per model, variant and fold: folds exploded over two literal lists, no join."""
    literals = {name: F.array(*[F.lit(v) for v in values]) for name, values in zip(EXPERIMENT, (models, variants))}
    grid = folds
    for name, values in literals.items():
        grid = grid.withColumn(name, F.explode(values))
    return grid


def with_threshold_flag(summary: DataFrame, gate: GateSettings = GateSettings()) -> DataFrame:
    ok = (F.col("mean_ic_pearson") >= gate.min_mean_ic) & (F.col("positive_fold_pct") >= gate.min_positive_share)
    return summary.withColumn("meets_threshold", F.coalesce(ok, F.lit(False)))


def rank_experiments(summary: DataFrame) -> DataFrame:
    """Best mean IC first; names break ties. One row per experiment, so the sort is small."""
    return summary.orderBy(F.desc_nulls_last("mean_ic_pearson"), *EXPERIMENT)


def report(summary: DataFrame) -> DataFrame:
    """The ranked metrics report written as CSV and JSON."""
    return rank_experiments(summary).select(F.col("model_name").alias("model"), "feature_variant", *REPORT)


def pick_winner(summary: DataFrame) -> DataFrame:
    """The best experiment that meets the threshold, else the best one overall."""
    return summary.orderBy(
        F.desc("meets_threshold"), F.desc_nulls_last("mean_ic_pearson"), *EXPERIMENT
    ).limit(1)


def current_production(registry: DataFrame, name: str = REGISTERED_MODEL_NAME) -> DataFrame:
    """The latest Production version and its mean IC; no row when there is none."""
    return (
        registry.filter((F.col("name") == name) & (F.col("stage") == PRODUCTION))
        .groupBy("name")
        .agg(F.max("version").alias("production_version"), F.max_by("tags", "version").alias("tags"))
        .select(
            "name", "production_version", F.expr("try_cast(tags['mean_ic_pearson'] as double)").alias("production_ic")
        )
    )


def promotion_gate(
    challenger: DataFrame, production: DataFrame, gate: GateSettings = GateSettings(),
    name: str = REGISTERED_MODEL_NAME,
) -> DataFrame:
    """challenger plus `passed` and every entry of `reasons` that applies; a NULL statistic fails its test.

    The conditions are independent and the threshold flag is not consulted. Without a Production version the
    comparison passes.
    """
    ic, share, current = F.col("mean_ic_pearson"), F.col("positive_fold_pct"), F.col("production_ic")
    checks = {
        "no completed folds": F.coalesce(F.col("n_folds"), F.lit(0)) <= 0,
        "mean_ic_pearson below floor": ic.isNull() | (ic < gate.min_mean_ic),
        "positive_fold_pct below floor": share.isNull() | (share < gate.min_positive_share),
        "mean_ic_pearson below production": ic < current - gate.regression_tolerance,
    }
    found = F.array(*[F.when(failed, F.lit(text)) for text, failed in checks.items()])
    return (
        challenger.withColumn("name", F.lit(name))
        .join(production.select("name", "production_ic"), "name", "left")
        .withColumn("reasons", F.filter(found, lambda reason: reason.isNotNull()))
        .withColumn("passed", F.size("reasons") == 0)
        .drop("name")
    )


def production_artifact(registry: DataFrame, name: str = REGISTERED_MODEL_NAME) -> str | None:
    """Where the latest Production version's model is; None when there is none."""
    latest = registry.filter((F.col("name") == name) & (F.col("stage") == PRODUCTION)).orderBy(F.desc("version")).first()
    return None if latest is None else latest.tags["artifact"]


def publish(
    registry: DataFrame, challenger: DataFrame, name: str = REGISTERED_MODEL_NAME, artifact: str | None = None
) -> DataFrame:
    """The next registry snapshot: the challenger as a new Production version, earlier ones archived.

    `artifact` is where its model is. A snapshot is never changed in place; `sources.commits` makes it visible.
    """
    tags = F.create_map(
        F.lit("mean_ic_pearson"), F.col("mean_ic_pearson").cast("string"),
        F.lit("positive_fold_pct"), F.col("positive_fold_pct").cast("string"),
        F.lit("source_run_id"), F.col("run_id"),
        *([F.lit("artifact"), F.lit(artifact)] if artifact is not None else []),
    )
    entry = challenger.select(
        F.lit(name).alias("name"), F.lit(None).cast("int").alias("version"), F.lit(PRODUCTION).alias("stage"),
        tags.alias("tags"),
    )
    replaced = (F.col("name") == name) & (F.col("stage") == PRODUCTION)
    demoted = registry.select(
        "name", "version", F.when(replaced, ARCHIVED).otherwise(F.col("stage")).alias("stage"), "tags"
    )
    newest = F.max("version").over(Window.partitionBy("name"))
    return demoted.unionByName(entry).withColumn(
        "version", F.coalesce("version", F.coalesce(newest, F.lit(0)) + 1)
    )
