"""Challenger -> gate -> final refit on all history -> artifact and registry."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk import schemas
from tidewalk.config import BASE_FEATURES, GARCH_FEATURES, TARGET, GateSettings, variant_uses_garch
from tidewalk.operators import folds as fold_ops
from tidewalk.operators import models, selection, volatility
from tidewalk.plans.cross_validation import run_parameters
from tidewalk.sources import commits, tables


def garch_final(frame: DataFrame, price: str = "nifty_close") -> DataFrame:
    """Volatility path of one fit per series over the whole frame."""
    fits = volatility.garch_fit(volatility.full_window(volatility.log_returns(frame, price)))
    return volatility.garch_path(fits)


def training_frame(frame: DataFrame, variant: str) -> DataFrame:
    """The modelling frame, with final volatility features where the variant uses them."""
    if not variant_uses_garch(variant):
        return frame
    return frame.join(garch_final(frame), ["series_id", "trade_date"], "left").na.drop(subset=GARCH_FEATURES)


def save_artifact(model: PipelineModel, metadata: DataFrame, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    tables.write_json(metadata, f"{path}/metadata")


def load_artifact(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    metadata = tables.read_json(spark, f"{path}/metadata", schemas.ARTIFACT)
    return PipelineModel.load(f"{path}/model"), metadata.first().asDict()


def promote(
    challenger: DataFrame, registry_root: str, snapshot: DataFrame, models_root: str,
    gate: GateSettings = GateSettings(), required: Sequence[str] = (TARGET, *BASE_FEATURES),
    overrides: dict | None = None,
) -> list[str]:
    """Refit and publish the challenger if it passes; returns the reasons it did not, and then writes nothing.

    The model goes to a folder of its own and is named in the new version's tags; the registry's commit comes last. A
    run that was cut off leaves files that nobody reads, and is simply run again. If another run published meanwhile,
    `commits.NumberTaken` is raised: the gate must then judge against that one.
    """
    spark = snapshot.sparkSession
    registry, number = commits.newest(spark, registry_root, schemas.REGISTRY)
    verdict = selection.promotion_gate(challenger, selection.current_production(registry), gate).first()
    if verdict is None:
        return ["no challenger"]
    if not verdict.passed:
        return list(verdict.reasons)
    columns = list(verdict.feature_cols)
    frame = tables.materialise(
        training_frame(fold_ops.model_frame(snapshot, required), verdict.feature_variant).select(
            "series_id", "trade_date", TARGET, *columns
        ),
        "refit",
    )
    model = models.refit(frame, verdict.model_name, columns, overrides)
    metadata = challenger.select(
        "model_name", "feature_variant", "feature_cols", F.lit(TARGET).alias("target"),
        F.lit(variant_uses_garch(verdict.feature_variant)).alias("uses_garch"),
        F.lit(frame.count()).alias("train_rows"), F.lit(len(columns)).alias("n_features"),
        F.create_map(*[
            F.lit(part) for pair in run_parameters(verdict.model_name, overrides).items() for part in pair
        ]).alias("params"),
        F.col("mean_ic_pearson").alias("walk_forward_mean_ic_pearson"),
        F.col("positive_fold_pct").alias("walk_forward_positive_fold_pct"),
        F.col("n_folds").alias("walk_forward_n_folds"),
        F.col("run_id").alias("source_run_id"),
    )
    artifact = f"{models_root}/{number + 1}-{uuid.uuid4().hex}"
    save_artifact(model, metadata, artifact)
    commits.commit(selection.publish(registry, challenger, artifact=artifact), registry_root, number + 1)
    return []


def serving_state(snapshot: DataFrame, price: str = "nifty_close") -> DataFrame:
    """Last volatility state per series from the raw snapshot, rows without a target included."""
    return volatility.last_state(garch_final(snapshot, price))
