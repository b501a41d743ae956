"""GARCH(1,1) volatility with Student-t errors, fitted per series and fold.

Spark holds one row per series with its returns (at most one a day) and the ends of its nested training windows, deals
the series to the cluster and fits a series' windows in one pass, each from the one before. Nothing else leaves the
JVM: forecasts are a closed form over row numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DateType, DoubleType, StructField, StructType

from tidewalk.config import DATE, SERIES, GarchParams
from tidewalk.functions.numeric import ratio
from tidewalk.operators import garch_math
from tidewalk.operators.returns import by_day, unique_day
from tidewalk.schemas import GARCH_FIT


def log_returns(frame: DataFrame, price: str = "nifty_close") -> DataFrame:
    """Log return against the previous surviving row, NULL on a series' first row and at prices <= 0.

    Differences run over the null-dropped frame, so they span removed days.
    """
    level = F.when(F.col(price) > 0, F.ln(F.col(price)))
    return frame.select(
        SERIES, unique_day(F.col(DATE)).alias(DATE), (level - F.lag(level).over(by_day())).alias("log_ret")
    )


def history_by_series(returns: DataFrame) -> DataFrame:
    """One row per series: day-ordered (day, percent return) of its non-null returns.

    `log_returns` admits one row a day, so the array is bounded by the calendar: 16 bytes a trading day.
    """
    point = F.struct(F.col(DATE).alias("day"), (F.col("log_ret") * F.lit(100.0)).alias("ret"))
    return (
        returns.filter("log_ret is not null")
        .groupBy(SERIES)
        .agg(F.array_sort(F.collect_list(point)).alias("history"))
    )


SERIES_PER_TASK = 50  # some tens of seconds for a decade of monthly folds each


def fit_partitions(spark: SparkSession, series: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-series // SERIES_PER_TASK))


def _spread(windows: DataFrame) -> DataFrame:
    """Series dealt evenly to tasks. The width is explicit: adaptive execution would merge partitions by their few bytes,
    but a fit costs CPU, not bytes."""
    n = windows.select(SERIES).distinct().count()
    return windows.repartition(fit_partitions(windows.sparkSession, n), SERIES)


def training_windows(returns: DataFrame, folds: DataFrame) -> DataFrame:
    """One row per series: its history and its windows (upto, fold_id, train_end), by the day they end.

    A series' training sets are nested, so its history travels once, whatever the number of folds; a window is the part
    of it up to the fold's embargo date. A calendar bounds both arrays.
    """
    window = F.struct(F.col("embargo_date").alias("upto"), "fold_id", "train_end")
    by_series = folds.groupBy(SERIES).agg(F.array_sort(F.collect_list(window)).alias("windows"))
    return _spread(history_by_series(returns).join(by_series, SERIES))


def full_window(returns: DataFrame) -> DataFrame:
    """One row per series whose one window is the whole history."""
    whole = F.array(F.struct(F.element_at("history", -1)["day"].alias("upto")))
    return _spread(history_by_series(returns).withColumn("windows", whole))


def _window_keys(windows: DataFrame) -> list[StructField]:
    """The columns that tell a window from the others of its series."""
    return [field for field in windows.schema["windows"].dataType.elementType if field.name != "upto"]


def _per_window(windows: DataFrame, result: StructType, run: Callable[[np.ndarray, list[int]], Iterator[dict]]) -> DataFrame:
    """One row per series and window: keys and what `run` gives for the window, from one pass over the series.

    `run` gets a series' percent returns and the lengths of its windows, in order. `days` are those of the window where
    `result` has them. Rows leave the task as they are made, so it holds one history and one window's arrays at a time.
    """
    keys = _window_keys(windows)
    schema = StructType([windows.schema[SERIES], *keys, *result.fields])
    arrow, with_days = to_arrow_schema(schema), "days" in result.fieldNames()

    def passes(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                history, ends = batch.column("history")[row].values, batch.column("windows")[row].as_py()
                days = history.field("day").to_numpy(zero_copy_only=False)
                returns = history.field("ret").to_numpy(zero_copy_only=False)
                sizes = np.searchsorted(days, np.array([w["upto"] for w in ends], days.dtype), side="right").tolist()
                for window, size, found in zip(ends, sizes, run(returns, sizes)):
                    told = {SERIES: batch.column(SERIES)[row], **window, **found}
                    if with_days:
                        told["days"] = history.field("day").slice(0, size)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([_plain(told[field.name])], field.type) for field in arrow
                    ], schema=arrow)

    return windows.select(SERIES, "history", "windows").mapInArrow(passes, schema)


def _plain(value):
    return value.as_py() if isinstance(value, pa.Scalar) else value


def garch_fit(windows: DataFrame, fixed: GarchParams | None = None) -> DataFrame:
    """Parameters, certificate, in-sample volatility path and next-step variance per window.

    A window's search starts, among others, at the estimate of the window before it, which holds most of its returns.
    A failed fit keeps its row: NULL parameters, NULL path, and the cause in `status`. Give `fixed` to run the
    recursion with known parameters; a window with at least the start-up rows is then a prefix of one path.
    """
    def fitted(returns: np.ndarray, sizes: list[int]) -> Iterator[dict]:
        near = None
        for size in sizes:
            row, found = garch_math.fit_row(returns[:size], near)
            near = found or near
            yield row

    def filtered(returns: np.ndarray, sizes: list[int]) -> Iterator[dict]:
        for size in sizes:
            yield garch_math.describe(returns[:size], asdict(fixed), "fixed")

    days = StructField("days", ArrayType(DateType()))
    return _per_window(windows, StructType([days, *GARCH_FIT.fields]), filtered if fixed else fitted)


def garch_loglik(windows: DataFrame, sets: Sequence[GarchParams]) -> DataFrame:
    """The log likelihood of every window under each of some parameter sets, as `loglik_1`, `loglik_2` and so on."""
    names = [f"loglik_{n}" for n in range(1, len(sets) + 1)]

    def told(returns: np.ndarray, sizes: list[int]) -> Iterator[dict]:
        for size in sizes:
            yield {name: -garch_math.neg_loglik(returns[:size], **asdict(params)) for name, params in zip(names, sets)}

    return _per_window(windows, StructType([StructField(name, DoubleType()) for name in names]), told)


def garch_path(fits: DataFrame) -> DataFrame:
    """In-sample volatility (as a fraction) and its change, one row per training day with a return."""
    keys = [c for c in fits.columns if c not in ("days", *GARCH_FIT.fieldNames())]
    sigma, before = F.col("point.sigma"), F.col("point.previous")
    previous = F.transform("sigma", lambda _, i: F.get("sigma", i - 1))
    points = F.arrays_zip(F.col("days").alias("day"), F.col("sigma"), previous.alias("previous"))
    return fits.filter("sigma is not null").select(*keys, F.explode(points).alias("point")).select(
        *keys, F.col("point.day").alias(DATE), sigma.alias("garch_sigma"), (sigma - before).alias("garch_sigma_chg")
    )


def forecast_variance(step: Column) -> Column:
    """Variance `step` >= 1 steps after the sample, from the fit columns."""
    persistence = F.col("alpha") + F.col("beta")
    steps_on = step - 1
    long_run = ratio(F.col("omega"), F.lit(1.0) - persistence)
    reverting = long_run + F.pow(persistence, steps_on) * (F.col("next_variance") - long_run)
    return F.when(persistence == 1.0, F.col("next_variance") + steps_on * F.col("omega")).otherwise(reverting)


def garch_forecast(fits: DataFrame, test_rows: DataFrame, embargo_gap: int = 0) -> DataFrame:
    """Forecast volatility for each fold's test days: the h-th test row takes step h. Other columns pass through.

    Step 1 goes to the first test row although embargoed rows lie before it; `embargo_gap` shifts the steps for
    an embargo-aware forecast. The first change is against the last in-sample volatility.
    """
    order = Window.partitionBy(SERIES, "fold_id").orderBy(DATE)
    state = fits.select(
        SERIES, "fold_id", "omega", "alpha", "beta", "next_variance", F.element_at("sigma", -1).alias("last_sigma")
    )
    sigma = F.sqrt(forecast_variance(F.col("step") + embargo_gap)) / F.lit(100.0)
    return (
        test_rows.withColumn("step", F.row_number().over(order))
        .join(state, [SERIES, "fold_id"], "left")
        .withColumn("garch_sigma", sigma)
        .select(
            *test_rows.columns, "garch_sigma",
            (F.col("garch_sigma") - F.coalesce(F.lag("garch_sigma").over(order), "last_sigma")).alias("garch_sigma_chg"),
        )
    )


def last_state(path: DataFrame) -> DataFrame:
    """The newest volatility and change of each series, used to fill scoring requests."""
    return path.groupBy(SERIES).agg(
        F.max_by(F.struct("garch_sigma", "garch_sigma_chg"), DATE).alias("last")
    ).select(SERIES, "last.*")
