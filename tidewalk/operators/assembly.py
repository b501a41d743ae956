"""Joining sides to a spine, filling columns, patching gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.config import GapPatch
from tidewalk.functions import ratio, round_f

DAY = ("series_id", "trade_date")


def one_row_per_day(df: DataFrame, keys: Sequence[str] = DAY) -> DataFrame:
    """df itself, or an error when a key repeats.

    The check is an aggregation by the key: repeats meet map-side, so even a day holding most of the table is found
    without gathering it, and the result is partitioned as the following join needs it.
    """
    values = [c for c in df.columns if c not in keys]
    message = F.concat(F.lit("more than one row for "), F.concat_ws(", ", *keys))
    single = F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(F.lit(True))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in values])
        .filter(single)
        .select(*df.columns)
    )


def star_join(spine: DataFrame, *sides: DataFrame, on: Sequence[str] = DAY) -> DataFrame:
    """Left-join every side to the spine by day.

    Sides come out of an aggregation by the same key, so at scale the joins reuse that partitioning and add no
    exchange of their own. Small sides are broadcast by the session's size threshold, never by a hint.
    """
    return reduce(lambda left, side: left.join(side, list(on), "left"), sides, spine)


def breadth_ratio(advances: Column, declines: Column) -> Column:
    return round_f(ratio(advances.cast("double"), declines), 4)


def fill_columns(
    df: DataFrame, source: DataFrame, mapping: Mapping[str, Column], on: Sequence[str] = DAY
) -> DataFrame:
    """Set columns from another relation by key, as an UPDATE ... FROM would.

    A column df lacks starts as NULL double. Rows without a match keep what they had; matched rows take the
    source value even when it is NULL.
    """
    incoming = source.select(
        *on, F.lit(True).alias("_matched"), *[value.alias(f"_new_{name}") for name, value in mapping.items()]
    )
    absent = {name: F.lit(None).cast("double") for name in mapping if name not in df.columns}
    joined = (df.withColumns(absent) if absent else df).join(incoming, list(on), "left")
    filled = {
        name: F.when(F.col("_matched"), F.col(f"_new_{name}")).otherwise(F.col(name)) for name in mapping
    }
    return joined.withColumns(filled).drop("_matched", *[f"_new_{name}" for name in mapping])


def patch_gaps(df: DataFrame, patches: Sequence[GapPatch], keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Apply each patch in turn; see GapPatch. Only existing rows change.

    The neighbour means are window aggregates over the series, so they share the exchange and the sort of the
    lead and lag windows around this step instead of reading the frame a second time.
    """
    series = Window.partitionBy(*keys)
    day = F.col("trade_date").cast("date")
    for patch in patches:
        neighbours = [F.to_date(F.lit(d)) for d in patch.neighbours]
        hit = (day == F.to_date(F.lit(patch.trade_date))) & F.col(patch.guard).isNull()
        if patch.series_id is not None:
            hit = hit & (F.col("series_id") == patch.series_id)
        df = df.withColumns({
            c: F.when(hit, F.avg(F.when(day.isin(neighbours), F.col(c))).over(series)).otherwise(F.col(c))
            for c in patch.columns
        })
    return df
