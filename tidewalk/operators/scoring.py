"""Validating and scoring feature rows; the same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewalk.config import DATE, GARCH_FEATURES, SERIES, TARGET


def _is_number(column: str) -> Column:
    """Whether the value is a finite number."""
    value = F.col(column).cast("double")
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def with_missing(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """`missing`: required features that are absent, NULL, NaN or infinite in the row, in column order."""
    absent = [F.lit(c) if c not in df.columns else F.when(~_is_number(c), F.lit(c)) for c in feature_cols]
    names = F.array(*absent) if absent else F.array().cast("array<string>")
    return df.withColumn("missing", F.filter(names, lambda name: name.isNotNull()))


def split_valid(df: DataFrame, feature_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that can be scored, rejected rows with `missing`)."""
    checked = with_missing(df, feature_cols)
    return checked.filter(F.size("missing") == 0).drop("missing"), checked.filter(F.size("missing") > 0)


def fill_garch(df: DataFrame, state: DataFrame) -> DataFrame:
    """Volatility features from the series' last fitted state, overwriting whatever a row supplied."""
    kept = df.drop(*GARCH_FEATURES)
    return kept.join(state.select(SERIES, *GARCH_FEATURES), SERIES, "left")


def score(
    df: DataFrame, model: PipelineModel, model_name: str, variant: str, feature_cols: Sequence[str],
    garch_state: DataFrame | None = None, keep: Sequence[str] = (SERIES, "trade_date"),
) -> DataFrame:
    """Predictions for the valid rows. `split_valid` gives the rejected ones."""
    filled = df if garch_state is None else fill_garch(df, garch_state)
    valid, _ = split_valid(filled, feature_cols)
    doubles = valid.withColumns({c: F.col(c).cast("double") for c in feature_cols})
    return model.transform(doubles).select(
        *keep, "prediction", F.lit(TARGET).alias("target"), F.lit(model_name).alias("model_name"),
        F.lit(variant).alias("feature_variant"),
    )


def sample_complete_row(
    df: DataFrame, feature_cols: Sequence[str], seed: int = 0, keys: Sequence[str] = (SERIES, DATE)
) -> DataFrame:
    """One random row with every feature present: the smallest hash of key and seed, however the rows are partitioned."""
    drawn = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return split_valid(df, feature_cols)[0].orderBy(drawn, *keys).limit(1)
