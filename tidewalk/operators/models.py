"""Tree ensembles on Spark ML, fitted per boundary over all series at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone
from threading import Lock, get_ident

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.config import DATE, GARCH_FEATURES, MODELS, SERIES, TARGET
from tidewalk.schemas import FIT_OUTCOMES, PREDICTIONS
from tidewalk.sources.tables import new_working_path

MIN_FIT_ROWS = 30
MIN_SCORE_ROWS = 2
ROWS_PER_TASK = 20_000  # training rows that are worth a task of their own
FITTED, TOO_FEW, FAILED = "fitted", "too few rows", "failed"
_REGRESSORS = {"forest": RandomForestRegressor, "boosted": GBTRegressor}


def make_estimator(name: str, overrides: dict | None = None, label: str = TARGET):
    """The regressor of a model family; `overrides` replace its published settings."""
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; choose one of {sorted(MODELS)}")
    settings = MODELS[name]
    return _REGRESSORS[settings.kind](featuresCol="features", labelCol=label, **{**settings.params, **(overrides or {})})


def make_pipeline(name: str, feature_cols: Sequence[str], overrides: dict | None = None) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[assembler, make_estimator(name, overrides)])


def fold_rows(ranged: DataFrame, boundary: date, garch: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of the folds starting at `boundary`: two filters on the fold ranges, no membership join.

    With several series a fit pools the folds that share a boundary date, and trains on the series that have one
    there. Every training label then ends by that date and every test row lies after it, for all series; ids would not
    do, since series of unequal length number their folds differently. `garch` adds the folds' volatility columns by
    day, NULL where there are none: an experiment that uses them leaves those rows out on both sides.
    """
    at = F.lit(boundary)
    test = ranged.filter(F.col("test_start") == at)
    train = ranged.filter((F.col("first_train_end") <= at) & (F.col("last_train_end") >= at))
    train = train.join(test.select(SERIES).distinct(), SERIES, "left_semi")
    if garch is not None:
        own = garch.filter(F.col("train_end") == at).select(SERIES, DATE, *GARCH_FEATURES)
        train, test = (side.join(own, [SERIES, DATE], "left") for side in (train, test))
    return train, test.withColumn("fold_id", F.col("test_fold"))


def usable_rows(rows: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """The rows that have the volatility columns an experiment uses."""
    needed = [c for c in GARCH_FEATURES if c in feature_cols]
    return rows.na.drop(subset=needed) if needed else rows


def in_few_tasks(rows: DataFrame) -> DataFrame:
    """Few rows in few tasks, since every level of a tree is a job. `rows` are persisted or come from files."""
    return rows.coalesce(max(1, rows.count() // ROWS_PER_TASK))


def run_fold(
    train: DataFrame, test: DataFrame, model_name: str, variant: str, feature_cols: Sequence[str],
    overrides: dict | None = None,
) -> DataFrame | None:
    """Test predictions of one experiment after one boundary, or None when it has too few rows left."""
    train, test = usable_rows(train, feature_cols), usable_rows(test, feature_cols)
    if train.limit(MIN_FIT_ROWS).count() < MIN_FIT_ROWS or test.limit(MIN_SCORE_ROWS).count() < MIN_SCORE_ROWS:
        return None
    model = make_pipeline(model_name, list(dict.fromkeys(feature_cols)), overrides).fit(train)
    return model.transform(test).select(
        F.lit(model_name).alias("model_name"), F.lit(variant).alias("feature_variant"), SERIES, "fold_id", DATE,
        "prediction", F.col(TARGET).alias("label"),
    )


class FitsFailed(RuntimeError):
    """Some fits of a cross-validation failed, so there is no whole result."""


class _Boundary:
    """The train and test rows of a boundary, read and joined once and kept while fits at it are left to do."""

    def __init__(self, start: date, fits: int, read: Callable[[], tuple[DataFrame, DataFrame]]):
        self.start, self.left, self.read, self.sides, self.lock = start, fits, read, None, Lock()

    def open(self) -> tuple[DataFrame, DataFrame]:
        with self.lock:
            if self.sides is None:
                train, test = (side.persist() for side in self.read())
                self.sides = in_few_tasks(train), test, train
            return self.sides[:2]

    def close(self) -> None:
        with self.lock:
            self.left -= 1
            if not self.left and self.sides is not None:
                for side in self.sides[1:]:
                    side.unpersist()
                self.sides = None


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """What has become of every fit in the folder."""
    try:
        return spark.read.schema(FIT_OUTCOMES).option("recursiveFileLookup", True).parquet(f"{folder}/outcomes")
    except AnalysisException as cause:
        if cause.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FIT_OUTCOMES)


def run_experiments(
    ranged: DataFrame, boundaries: Sequence[date], experiments: Sequence[tuple[str, str, Sequence[str]]],
    garch: DataFrame | None = None, overrides: dict | None = None, in_flight: int | None = None,
    folder: str | None = None, partial: bool | None = None,
) -> DataFrame | None:
    """Test predictions of every (model, variant, columns) at every boundary; None when none had enough rows.

    The fits wait in one queue, the latest boundaries, whose training sets are longest, first. A fit is a chain of small
    jobs, so as many are in flight as the cluster has cores for them (`in_flight`, by default a fit per core divided by
    the tasks of the largest fit), each in a pool of its own: under the FAIR scheduler none waits for another's stages.
    A boundary's rows are kept while its fits are under way. Predictions are written as each fit finishes and read back
    as one table, so they neither pile up in a plan nor pass the driver. A failed fit is recorded in `outcomes` and the
    others go on; then `FitsFailed` is raised, as predictions without a failed fit's would look whole. Only with
    `partial`, by default where the caller gives a `folder` whose `outcomes` it can read, are the others' returned, if
    there are any.
    Called again with the same `folder`, only fits that are missing there or failed are run.
    """
    spark = ranged.sparkSession
    base = folder or new_working_path(spark, "predictions")
    done = {(r.model_name, r.feature_variant, r.boundary): r.status for r in outcomes(spark, base).collect()}
    columns = list(dict.fromkeys(c for *_, names in experiments for c in names))
    uses_garch = bool(set(GARCH_FEATURES) & set(columns))

    def sides(boundary: date) -> tuple[DataFrame, DataFrame]:
        train, test = fold_rows(ranged, boundary, garch if uses_garch else None)
        kept = [SERIES, DATE, TARGET, *columns]
        return train.select(kept), test.select(*kept, "fold_id")

    queue = []
    for boundary in sorted(set(boundaries), reverse=True):
        left = [e for e in experiments if done.get((e[0], e[1], boundary), FAILED).startswith(FAILED)]
        shared = _Boundary(boundary, len(left), lambda boundary=boundary: sides(boundary))
        queue += [(shared, experiment) for experiment in left]
    causes: list[Exception] = []

    def fit(job: tuple[_Boundary, tuple]) -> str:
        shared, (name, variant, names) = job
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{get_ident()}")
        try:
            predicted = run_fold(*shared.open(), name, variant, names, overrides)
            if predicted is not None:
                predicted.write.mode("overwrite").parquet(f"{base}/predictions/{name}/{variant}/{shared.start}")
            status = TOO_FEW if predicted is None else FITTED
        except Exception as cause:  # noqa: BLE001  one bad fit must not cost the others
            status = f"{FAILED}: {str(cause)[:300]}"
            causes.append(cause)
        finally:
            shared.close()
        row = [(name, variant, shared.start, status, datetime.now(timezone.utc))]
        told = spark.createDataFrame(row, FIT_OUTCOMES).coalesce(1)
        told.write.mode("overwrite").parquet(f"{base}/outcomes/{name}/{variant}/{shared.start}")
        return status

    if in_flight is None:
        tasks = max(1, ranged.count() // ROWS_PER_TASK) if queue else 1
        in_flight = max(1, spark.sparkContext.defaultParallelism // tasks)
    with ThreadPoolExecutor(in_flight) as pool:
        statuses = list(pool.map(fit, queue)) + list(done.values())
    whole = folder is None if partial is None else not partial
    if causes and (whole or FITTED not in statuses):
        raise FitsFailed(
            f"{len(causes)} of {len(queue)} fits failed, as {base}/outcomes tells; one of them: {causes[0]}"
        ) from causes[0]
    if FITTED not in statuses:
        return None
    reader = spark.read.schema(PREDICTIONS).option("recursiveFileLookup", True)
    return reader.parquet(f"{base}/predictions")


def refit(frame: DataFrame, model_name: str, feature_cols: Sequence[str], overrides: dict | None = None) -> PipelineModel:
    """The final fit on all history, read once."""
    kept = frame.persist()
    try:
        return make_pipeline(model_name, feature_cols, overrides).fit(in_few_tasks(kept))
    finally:
        kept.unpersist()
