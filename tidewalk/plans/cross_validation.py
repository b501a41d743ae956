"""Snapshot -> folds -> volatility -> fits -> metrics -> winner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewalk.config import BASE_FEATURES, FEATURE_VARIANTS, MODELS, TARGET, FoldSettings, GateSettings
from tidewalk.operators import folds as fold_ops
from tidewalk.operators import metrics, models, selection, volatility
from tidewalk.schemas import RUNS
from tidewalk.sources import tables


@dataclass
class WalkForward:
    """Frames the fits read many times, held as files in the shared working folder."""

    ranged: DataFrame
    folds: DataFrame
    garch: DataFrame | None

    def boundaries(self) -> list[date]:
        """Distinct fold starts: one a month, or at most one a day where series keep different calendars."""
        return [row.train_end for row in self.folds.select("train_end").distinct().orderBy("train_end").collect()]


def garch_features(
    frame: DataFrame, folds: DataFrame, ranged: DataFrame, price: str = "nifty_close", embargo_gap: int = 0
) -> DataFrame:
    """Volatility features per (series, fold, day): the in-sample path on training days, forecasts on test days.

    One fitting pass serves every model; its result is written out before path and forecast read it.
    """
    fits = tables.materialise(
        volatility.garch_fit(volatility.training_windows(volatility.log_returns(frame, price), folds)), "garch-fits"
    )
    test_rows = ranged.filter("test_fold is not null").select(
        "series_id", F.col("test_fold").alias("fold_id"), F.col("test_start").alias("train_end"), "trade_date"
    )
    return volatility.garch_path(fits).unionByName(volatility.garch_forecast(fits, test_rows, embargo_gap))


def prepare(
    snapshot: DataFrame, boundaries: DataFrame, required: Sequence[str] = (TARGET, *BASE_FEATURES),
    settings: FoldSettings = FoldSettings(), with_garch: bool = True,
) -> WalkForward:
    frame = fold_ops.model_frame(snapshot, required)
    folds = tables.materialise(fold_ops.build_folds(frame, boundaries, settings), "folds")
    # Sorted by day a fold's training rows are a prefix of every file and its test rows one stretch of it.
    ranged = tables.materialise(fold_ops.with_fold_ranges(frame, folds), "ranged", ["trade_date"])
    garch = None
    if with_garch:
        garch = tables.materialise(garch_features(ranged, folds, ranged), "garch", ["train_end", "trade_date"])
    return WalkForward(ranged, folds, garch)


def predictions(
    work: WalkForward, model_names: Sequence[str] = tuple(MODELS),
    variants: Mapping[str, Sequence[str]] = FEATURE_VARIANTS, boundaries: Sequence[date] | None = None,
    overrides: dict | None = None, in_flight: int | None = None, folder: str | None = None,
) -> DataFrame | None:
    """Test predictions of all experiments; give `folder` to resume a run that was cut off.

    A failed fit raises once the others are done, with a `folder` too: what is ranked next must be whole.
    """
    experiments = [(name, variant, columns) for name in model_names for variant, columns in variants.items()]
    return models.run_experiments(
        work.ranged, work.boundaries() if boundaries is None else boundaries, experiments, work.garch, overrides,
        in_flight, folder, partial=False,
    )


def evaluate(predicted: DataFrame, gate: GateSettings = GateSettings()) -> tuple[DataFrame, DataFrame]:
    """(fold results, summaries with the threshold flag); the results are written once and then summarised."""
    results = tables.materialise(metrics.fold_metrics(predicted), "fold-results")
    return results, selection.with_threshold_flag(metrics.summarize_folds(results), gate)


def run_parameters(model_name: str, overrides: dict | None = None) -> dict[str, str]:
    """Every setting of a model family's fits, as text."""
    published = MODELS[model_name].params if model_name in MODELS else {}
    return {key: str(value) for key, value in {**published, **(overrides or {})}.items()}


def log_runs(
    results: DataFrame, summary: DataFrame, folds: DataFrame, variants: Mapping[str, Sequence[str]], run_group: str,
    root: str, model_names: Sequence[str] = tuple(MODELS), overrides: dict | None = None,
) -> DataFrame:
    """Write one row per experiment to `runs` and its folds to `fold_results`; returns the rows of `runs`.

    Every experiment of the grid has a row: `no_valid_folds` without any prediction, else `ok`, also when no fold has
    an information coefficient. Writing a group again replaces that group and no other: every output has a folder
    `run_group=` of its own. The fold results also go out as CSV, and the ranked report as CSV and JSON.
    """
    spark = summary.sparkSession
    requested = folds.select("train_end").distinct().count()
    grid = spark.createDataFrame([
        (f"{run_group}__{name}__{variant}", name, variant, list(columns), run_parameters(name, overrides), TARGET,
         len(columns), requested)
        for name in model_names for variant, columns in variants.items()
    ], StructType(RUNS.fields[:8]))
    measured = summary.withColumn("status", F.lit("ok"))
    runs = tables.materialise(
        grid.join(measured, ["model_name", "feature_variant"], "left").select(
            *RUNS.fieldNames()[:8], F.coalesce("status", F.lit("no_valid_folds")).alias("status"),
            F.coalesce("meets_threshold", F.lit(False)).alias("meets_threshold"),
            F.coalesce("n_folds", F.lit(0)).cast("long").alias("n_folds"), *RUNS.fieldNames()[11:],
        ),
        "runs",
    )
    run_id = F.concat_ws("__", F.lit(run_group), "model_name", "feature_variant").alias("run_id")
    starts = folds.select("series_id", "fold_id", F.date_format("test_start", "yyyy-MM-dd").alias("test_start"))
    fold_rows = results.join(starts, ["series_id", "fold_id"]).select(
        run_id, "model_name", "feature_variant", "series_id", F.col("fold_id").alias("fold"), "test_start",
        *metrics.METRICS, "n_test",
    )
    runs.write.mode("overwrite").parquet(of_group(root, "runs", run_group))
    fold_rows.write.mode("overwrite").parquet(of_group(root, "fold_results", run_group))
    tables.write_csv(fold_rows, of_group(root, "csv/fold_results", run_group))
    tables.write_csv(selection.report(summary), of_group(root, "csv/cv_metrics", run_group))
    tables.write_json(selection.report(summary), of_group(root, "json/cv_metrics", run_group))
    tables.write_json(
        selection.pick_winner(runs).select(
            "run_id", "model_name", "feature_variant", "feature_cols", "mean_ic_pearson", "positive_fold_pct",
            "meets_threshold", "n_folds",
        ),
        of_group(root, "json/best_config", run_group),
    )
    return runs


def of_group(root: str, output: str, run_group: str) -> str:
    """Where an output of a run group is; reading the folder above gives all groups with a `run_group` column."""
    return f"{root}/{output}/run_group={run_group}"
