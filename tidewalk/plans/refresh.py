"""Adding new days to a feature snapshot without computing its history again.

A day's features depend on the days around it: returns look up to 20 rows ahead, deltas 5 rows back, and a gap patch at
its neighbours. So new days change the last 20 rows of their series, and what these need lies a few rows further back.
Only that stretch of the market tables is read, and only the months it touches are written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewalk import schemas
from tidewalk.config import KNOWN_GAPS, GapPatch, MarketNames
from tidewalk.operators.returns import index_levels
from tidewalk.plans.daily_features import daily_features
from tidewalk.sources import tables

ROWS_AHEAD, ROWS_BACK = 20, 5  # of the longest forward return and of the deltas
MONTH = "month"


def write_monthly(frame: DataFrame, path: str) -> None:
    """Write features in a folder per month, replacing the months that the frame has and no other."""
    monthly = frame.withColumn(MONTH, F.date_format("trade_date", "yyyy-MM"))
    (
        monthly.repartition(MONTH).sortWithinPartitions(MONTH, "trade_date", "series_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    )


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot, with its month: filters on it leave folders unread."""
    schema = StructType([*schemas.SNAPSHOT.fields, StructField(MONTH, StringType())])
    return spark.read.schema(schema).parquet(path)


def _nth_last_day(days: DataFrame, n: int) -> DataFrame:
    """(series_id, day): the n-th last day of every series, its first one if it has fewer."""
    newest = Window.partitionBy("series_id").orderBy(F.desc("trade_date"))
    ranked = days.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= n)
    return ranked.groupBy("series_id").agg(F.min("trade_date").alias("day"))


def _day(text: str) -> Column:
    return F.to_date(F.lit(text))


def stretches(
    known: DataFrame, spine: DataFrame, patches: Sequence[GapPatch] = KNOWN_GAPS
) -> DataFrame:
    """(series_id, redo, since) of the series that have new days: the first day that they change, and the first day that
    computing it takes. `known` and `spine` are the (series_id, trade_date) of the snapshot and of the sources."""
    last = known.groupBy("series_id").agg(F.max("trade_date").alias("last"))
    grown = (
        spine.groupBy("series_id").agg(F.max("trade_date").alias("newest"), F.min("trade_date").alias("oldest"))
        .join(last, "series_id", "left")
        .where(F.col("last").isNull() | (F.col("newest") > F.col("last")))
    )
    redo = F.coalesce("day", "oldest")
    for patch in patches:  # one day before the new ones whose neighbours are among them
        late = F.col("last") < _day(max(patch.neighbours))
        redo = F.when(late, F.least(redo, _day(patch.trade_date))).otherwise(redo)
    changed = grown.join(_nth_last_day(known, ROWS_AHEAD), "series_id", "left").select("series_id", redo.alias("redo"))
    before = known.join(changed, "series_id").where(F.col("trade_date") < F.col("redo"))
    since = F.coalesce("day", "redo")
    for patch in sorted(patches, key=lambda p: p.trade_date, reverse=True):  # a patched day is read with its neighbours
        read = since <= _day(patch.trade_date)
        since = F.when(read, F.least(since, _day(min(patch.neighbours)))).otherwise(since)
    return changed.join(_nth_last_day(before, ROWS_BACK), "series_id", "left").select("series_id", "redo", since.alias("since"))


def _stretch(table: DataFrame, since: DataFrame, first: str) -> DataFrame:
    """The rows of a dated table from the series' day on; the earliest of these days reaches the scan as a filter."""
    late = table.where(F.col("trade_date") >= _day(first))
    return late.join(since, "series_id").where(F.col("trade_date") >= F.col("since")).select(*table.columns)


def refresh(
    sources: Mapping[str, DataFrame], path: str, names: MarketNames = MarketNames(),
    patches: Sequence[GapPatch] = KNOWN_GAPS,
) -> int:
    """Bring the monthly snapshot at `path` up to the days of the market tables; returns how many months were written.

    New days are those behind a series' last day in the snapshot; series that have none are not read. Earlier days are
    taken as they were: after a correction in the sources write the snapshot anew. The months that change are written
    beside the snapshot first and then replaced folder by folder, so a run that is cut off is repaired by the next one.
    """
    prices = sources["market_activity_index"]
    spark = prices.sparkSession
    spine = index_levels(prices, names.price_index, names.volatility_index).select("series_id", "trade_date")
    old = read_monthly(spark, path)
    found = tables.materialise(stretches(old.select("series_id", "trade_date"), spine, patches), "stretches")
    first = found.agg(F.min("since").cast("string"), F.min("redo").cast("string")).first()
    if first[0] is None:
        return 0
    since = found.select("series_id", "since")
    cut = {
        name: _stretch(table, since, first[0]) if "trade_date" in table.columns else table for name, table in sources.items()
    }
    redone = daily_features(cut, names, patches).join(found.select("series_id", "redo"), "series_id").where(
        F.col("trade_date") >= F.col("redo")
    ).select(*schemas.SNAPSHOT.fieldNames())
    # the other rows of the months that change: earlier days, and series without new days
    touched = old.where(F.col(MONTH) >= first[1][:7]).drop(MONTH)
    kept = touched.join(found.select("series_id", "redo"), "series_id", "left").where(
        F.col("redo").isNull() | (F.col("trade_date") < F.col("redo"))
    ).select(*schemas.SNAPSHOT.fieldNames())
    changed = tables.materialise(kept.unionByName(redone), "refreshed")
    write_monthly(changed, path)
    return changed.select(F.date_format("trade_date", "yyyy-MM").alias(MONTH)).distinct().count()
