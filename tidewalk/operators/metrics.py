"""Information coefficients, error measures and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.functions import average_rank, is_near_constant, pearson, ratio

FOLD_KEYS = ("model_name", "feature_variant", "series_id", "fold_id")
METRICS = ("ic_pearson", "ic_spearman", "rmse", "dir_acc")


def fold_metrics(predictions: DataFrame, group_cols: Sequence[str] = FOLD_KEYS) -> DataFrame:
    """Pearson and Spearman IC, RMSE and directional accuracy per group.

    All are NULL for two rows or fewer; both ICs are NULL when either side is nearly constant. A group is one
    fold's test rows, a month of one series, so its ranks fit one task. Ranks and sums share one exchange.
    """
    group = Window.partitionBy(*group_cols)
    p, y = F.col("prediction"), F.col("label")
    ranked = predictions.withColumns({"_rp": average_rank(p, group), "_ry": average_rank(y, group)})
    summary = ranked.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_test"),
        (is_near_constant(p, F.col("trade_date")) | is_near_constant(y, F.col("trade_date"))).alias("_flat"),
        pearson(p, y).alias("_pearson"),
        pearson(F.col("_rp"), F.col("_ry")).alias("_spearman"),
        F.sqrt(F.avg((p - y) * (p - y))).alias("_rmse"),
        F.avg((F.signum(p) == F.signum(y)).cast("double")).alias("_dir_acc"),
    )
    enough = F.col("n_test") > 2
    return summary.select(
        *group_cols,
        F.when(enough & ~F.col("_flat"), F.col("_pearson")).alias("ic_pearson"),
        F.when(enough & ~F.col("_flat"), F.col("_spearman")).alias("ic_spearman"),
        F.when(enough, F.col("_rmse")).alias("rmse"),
        F.when(enough, F.col("_dir_acc")).alias("dir_acc"),
        "n_test",
    )


def summarize_folds(
    fold_results: DataFrame, group_cols: Sequence[str] = ("model_name", "feature_variant")
) -> DataFrame:
    """Means, sample t-statistic of the Pearson IC, and the share of all folds whose IC is positive."""
    ic = F.nanvl("ic_pearson", F.lit(None).cast("double"))
    values = fold_results.withColumn("ic_pearson", ic)
    spread, n = F.stddev_samp("ic_pearson"), F.count("ic_pearson")
    error = F.when((n > 1) & (spread > 0), spread / F.sqrt(n))
    return values.groupBy(*group_cols).agg(
        n.alias("n_folds"),
        F.avg("ic_pearson").alias("mean_ic_pearson"),
        F.avg("ic_spearman").alias("mean_ic_spearman"),
        ratio(F.avg("ic_pearson"), error).alias("ic_t_stat"),
        F.avg(F.when(F.col("ic_pearson") > 0, 1.0).otherwise(0.0)).alias("positive_fold_pct"),
        F.avg("rmse").alias("mean_rmse"),
        F.avg("dir_acc").alias("mean_dir_acc"),
    )
