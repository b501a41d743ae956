"""Option-chain and futures measures, one row per series and day.

Every measure cuts its rows before the shuffle, so a day with very many contracts costs a handful of rows per task:
sums combine map-side, and rankings are filtered on their rank, which Spark turns into a WindowGroupLimit. Ratio and
ranking read the chain separately for that reason; one shared pass would have to shuffle every contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.functions import ratio, round_f

DAY = ("series_id", "trade_date")


def contracts_of(df: DataFrame, ticker: str, instrument_type: str) -> DataFrame:
    return df.filter((F.col("ticker") == ticker) & (F.col("instrument_type") == instrument_type))


def top_by_liquidity(options: DataFrame, k: int = 3) -> DataFrame:
    """The k expiries with the largest open interest each day; the nearer expiry wins a tie."""
    ranked = Window.partitionBy(*DAY).orderBy(F.desc_nulls_last("open_interest"), "expiry")
    return (
        options.withColumn("open_interest", F.col("pe_oi") + F.col("ce_oi"))
        .withColumn("liquidity_rank", F.row_number().over(ranked))
        .filter(F.col("liquidity_rank") <= k)
    )


def put_call_ratio(options: DataFrame) -> DataFrame:
    return options.groupBy(*DAY).agg(round_f(ratio(F.sum("pe_oi"), F.sum("ce_oi")), 4).alias("pcr"))


def max_pain_distance(options: DataFrame, k: int = 3) -> DataFrame:
    """Distance of the underlying from max pain in percent, weighted by open interest over the top k expiries.

    A NULL distance leaves the numerator but its weight stays in the denominator.
    """
    distance = ratio(F.col("underlying_price") - F.col("max_pain"), F.col("max_pain")) * F.lit(100.0)
    weight = F.col("open_interest")
    return top_by_liquidity(options, k).groupBy(*DAY).agg(
        round_f(ratio(F.sum(distance * weight), F.sum(weight)), 4).alias("max_pain_dist_pct")
    )


def nearest_expiry(futures: DataFrame) -> DataFrame:
    """Every contract at the day's earliest expiry; ties are kept.

    The minimum combines map-side and the join takes any number of ties: adaptive execution splits a hot day.
    """
    soonest = futures.groupBy(*DAY).agg(F.min("expiry").alias("expiry"))
    return futures.join(soonest, [*DAY, "expiry"], "left_semi")
