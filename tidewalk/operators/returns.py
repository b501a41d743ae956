"""Forward returns, row positions and lagged changes of ordered series.

All windows here are partitioned by series and ordered by day. A series has at most one row a day, so a window partition
is bounded by the calendar however many raw rows one instrument has: the aggregations behind the features reduce to
(series, day) before the exchange by series, `assembly.one_row_per_day` checks the sides that are not aggregated, and
`unique_day` turns a repeat in any other input into an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewalk.functions import pct_change, round_f

KEYS = ("series_id",)


def by_day(keys: Sequence[str] = KEYS, order: str = "trade_date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def unique_day(value: Column, keys: Sequence[str] = KEYS, order: str = "trade_date") -> Column:
    """`value`, or an error when its series has a second row on that day. Shares the caller's window."""
    repeated = F.lag(order).over(by_day(keys, order)) == F.col(order)
    message = F.concat(F.lit("more than one row for "), F.concat_ws(", ", *keys, order))
    return F.when(repeated, F.raise_error(message)).otherwise(value)


def index_levels(df: DataFrame, price_index: str, volatility_index: str) -> DataFrame:
    """Price and volatility index side by side, one row per day that has a price row.

    One aggregation replaces the self-join. A repeated (day, index) row is an error, found in the same pass.
    """
    def level(name: str) -> Column:
        here = F.col("index_name") == name
        n = F.count(F.when(here, 1))
        return F.when(n > 1, F.raise_error(F.lit(f"more than one {name} row for a day"))).otherwise(
            F.max(F.when(here, F.col("close")))
        )

    return (
        df.filter(F.col("index_name").isin(price_index, volatility_index))
        .groupBy("series_id", "trade_date")
        .agg(
            level(price_index).alias("close"),
            level(volatility_index).alias("vix_close"),
            F.count(F.when(F.col("index_name") == price_index, 1)).alias("price_rows"),
        )
        .filter("price_rows > 0")
        .drop("price_rows")
    )


def forward_returns(
    df: DataFrame, price: str = "close", horizons: Sequence[int] = (1, 5, 20), keys: Sequence[str] = KEYS,
    order: str = "trade_date",
) -> DataFrame:
    """Percent change to the n-th next row per horizon, and `up_1d`, which is 0 where there is no next row."""
    days = by_day(keys, order)
    now = F.col(price)
    returns = {
        f"fwd_ret_{n}d": round_f(pct_change(F.lead(price, n).over(days), now), 4) for n in horizons
    }
    checked = unique_day(now, keys, order)
    return df.withColumns({
        price: checked, **returns, "up_1d": F.when(F.lead(price, 1).over(days) > now, 1).otherwise(0),
    })


def with_position(df: DataFrame, keys: Sequence[str] = KEYS, order: str = "trade_date", name: str = "pos") -> DataFrame:
    """0-based position of each row in its series."""
    position = (F.row_number().over(by_day(keys, order)) - 1).cast("long")
    return df.withColumn(name, unique_day(position, keys, order))


def lag_deltas(
    df: DataFrame, columns: Mapping[str, str], rows: int = 5, keys: Sequence[str] = KEYS, order: str = "trade_date"
) -> DataFrame:
    """new name -> source column: change against the row `rows` earlier (rows, not days; not rounded)."""
    days = by_day(keys, order)
    return df.withColumns({new: F.col(c) - F.lag(c, rows).over(days) for new, c in columns.items()})


def vol_spread(volatility_index: Column, daily_vol: Column) -> Column:
    """Volatility index minus the daily volatility annualised over 252 days, in percent."""
    return volatility_index - daily_vol * F.sqrt(F.lit(252.0)) * F.lit(100.0)
