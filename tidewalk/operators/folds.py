"""Monthly boundaries, the modelling frame and expiry-aligned walk-forward folds.

Folds are built from row positions, never from a rows x folds join: rows and boundaries of a series are laid on one
timeline and every "last row up to", "first boundary from" question is a running aggregate over it. A frame row
carries the *range* of folds it trains (training sets are nested) and the one fold it tests, so membership costs one
row per row; `fold_membership` expands the ranges where a consumer needs pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.config import FoldSettings
from tidewalk.operators.returns import by_day, unique_day, with_position


def monthly_boundaries(instruments: DataFrame, features: DataFrame, ticker: str) -> DataFrame:
    """Latest expiry of each calendar month within a series' feature dates.

    The last partial month yields its latest expiry in range, possibly a weekly one.
    """
    span = features.groupBy("series_id").agg(
        F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day")
    )
    return (
        instruments.filter((F.col("ticker") == ticker) & F.col("expiry").isNotNull())
        .select("series_id", "expiry")
        .distinct()
        .join(span, "series_id")
        .filter(F.col("expiry").between(F.col("first_day"), F.col("last_day")))
        .groupBy("series_id", F.trunc("expiry", "month").alias("month"))
        .agg(F.max("expiry").alias("expiry"))
        .select("series_id", "expiry")
    )


def model_frame(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows complete in every required column, with their position among the survivors."""
    dated = df.withColumn("trade_date", F.col("trade_date").cast("date"))
    return with_position(dated.na.drop(subset=list(required)))


def boundary_positions(frame: DataFrame, boundaries: DataFrame, settings: FoldSettings = FoldSettings()) -> DataFrame:
    """Per boundary up to the last frame day: number of rows up to it, and the embargoed last training day."""
    embargo = F.lag("trade_date", settings.embargo_rows).over(by_day())
    rows = frame.select(
        "series_id", unique_day(F.col("trade_date")).alias("at"), F.lit(False).alias("is_boundary"),
        embargo.alias("embargo_date"),
    )
    marks = boundaries.select(
        "series_id", F.col("expiry").alias("at"), F.lit(True).alias("is_boundary"),
        F.lit(None).cast("date").alias("embargo_date"),
    )
    timeline = Window.partitionBy("series_id").orderBy("at", "is_boundary").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = Window.partitionBy("series_id")
    return (
        rows.unionByName(marks)
        .select(
            "series_id", "at", "is_boundary",
            F.count(F.when(~F.col("is_boundary"), 1)).over(timeline).alias("rows_up_to"),
            F.last("embargo_date", ignorenulls=True).over(timeline).alias("embargo_date"),
            F.max(F.when(~F.col("is_boundary"), F.col("at"))).over(whole).alias("last_day"),
        )
        .filter(F.col("is_boundary") & (F.col("at") <= F.col("last_day")))
        .select("series_id", F.col("at").alias("expiry"), "rows_up_to", "embargo_date")
    )


def boundary_pairs(positions: DataFrame, settings: FoldSettings = FoldSettings()) -> DataFrame:
    """Consecutive boundaries from the first one with enough boundaries before it."""
    order = Window.partitionBy("series_id").orderBy("expiry")
    return (
        positions.select(
            "*",
            (F.row_number().over(order) - 1).alias("boundary_no"),
            F.lead("expiry").over(order).alias("next_expiry"),
            F.lead("rows_up_to").over(order).alias("next_rows_up_to"),
        )
        .filter(F.col("next_expiry").isNotNull() & (F.col("boundary_no") >= settings.min_train_boundaries))
    )


def build_folds(frame: DataFrame, boundaries: DataFrame, settings: FoldSettings = FoldSettings()) -> DataFrame:
    """Train up to the embargo before a boundary, test until the next one; ids are dense over accepted folds."""
    n_train = F.col("rows_up_to") - settings.embargo_rows
    n_test = F.col("next_rows_up_to") - F.col("rows_up_to")
    accepted = boundary_pairs(boundary_positions(frame, boundaries, settings), settings).filter(
        (n_train >= max(settings.min_train_rows, 1)) & (n_test >= settings.min_test_rows)
    )
    order = Window.partitionBy("series_id").orderBy("expiry")
    return accepted.select(
        "series_id",
        (F.row_number().over(order) - 1).alias("fold_id"),
        F.col("expiry").alias("train_end"),
        F.col("expiry").alias("test_start"),
        F.col("next_expiry").alias("test_end"),
        "embargo_date",
        n_train.alias("n_train"),
        n_test.alias("n_test"),
    )


def with_fold_ranges(frame: DataFrame, folds: DataFrame) -> DataFrame:
    """Every frame row with the folds it serves: it trains `first_train_fold` to `last_fold` and tests `test_fold`.

    `first_train_end`, `last_train_end` and `test_start` are the same folds by their boundary date, which is what
    folds of different series have in common. Fold marks join the rows' timeline; going back in time, the lowest fold
    seen so far is the first whose embargo date (or test end) is not before the row.
    """
    rows = frame.withColumns({"_at": F.col("trade_date"), "_mark": F.lit(False)})
    fold = F.struct("fold_id", F.col("train_end").alias("start"))
    none = F.lit(None).cast("struct<fold_id:int,start:date>")
    marks = folds.select(
        "series_id", F.lit(True).alias("_mark"),
        F.inline(F.array(
            F.struct(F.col("embargo_date").alias("_at"), fold.alias("_train"), none.alias("_test")),
            F.struct(F.col("test_end").alias("_at"), none.alias("_train"), fold.alias("_test")),
        )),
    )
    back = Window.partitionBy("series_id").orderBy(F.desc("_at"), F.desc("_mark")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = Window.partitionBy("series_id")
    tested = F.when(F.col("trade_date") > F.col("_next.start"), F.col("_next"))
    return (
        rows.unionByName(marks, allowMissingColumns=True)
        .withColumns({
            "_first": F.min("_train").over(back),
            "_next": F.min("_test").over(back),
            "_last": F.max("_train").over(whole),
        })
        .filter(~F.col("_mark"))
        .withColumn("_tested", tested)
        .select(
            *frame.columns,
            F.col("_first.fold_id").alias("first_train_fold"), F.col("_last.fold_id").alias("last_fold"),
            F.col("_tested.fold_id").alias("test_fold"), F.col("_first.start").alias("first_train_end"),
            F.col("_last.start").alias("last_train_end"), F.col("_tested.start").alias("test_start"),
        )
    )


def fold_membership(ranged: DataFrame, *columns: str) -> DataFrame:
    """(series, fold, role, day) pairs, plus any frame columns named; no join."""
    trains = F.when(
        F.col("first_train_fold").isNotNull(),
        F.transform(
            F.sequence("first_train_fold", "last_fold"),
            lambda fold: F.struct(fold.alias("fold_id"), F.lit("train").alias("role")),
        ),
    )
    tests = F.when(
        F.col("test_fold").isNotNull(),
        F.array(F.struct(F.col("test_fold").alias("fold_id"), F.lit("test").alias("role"))),
    )
    none = F.array().cast("array<struct<fold_id:int,role:string>>")
    return ranged.select(
        "series_id", "trade_date", *columns, F.inline(F.concat(F.coalesce(trains, none), F.coalesce(tests, none)))
    )


def fold_sizes(membership: DataFrame) -> DataFrame:
    return membership.groupBy("series_id", "fold_id", "role").agg(F.count(F.lit(1)).alias("n_rows"))


def fold_overlap(ranged: DataFrame, folds: DataFrame) -> DataFrame:
    """Rows a fold both trains and tests on; 0 everywhere when the embargo holds."""
    shared = (
        ranged.filter(F.col("first_train_fold") <= F.col("test_fold"))
        .groupBy("series_id", F.col("test_fold").alias("fold_id"))
        .agg(F.count(F.lit(1)).alias("n_shared"))
    )
    return folds.select("series_id", "fold_id").join(shared, ["series_id", "fold_id"], "left").select(
        "series_id", "fold_id", F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared")
    )
