"""Column arithmetic shared by the feature operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_f(x: Column, places: int) -> Column:
    """Round the scaled double, so 1.005 -> 1.0 at two places as double arithmetic has it.

    Spark's own round(x, n) goes through the decimal text of x and gives 1.01.
    """
    scale = F.lit(float(10**places))
    return F.round(x * scale, 0) / scale


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(a, b)


def pct_change(new: Column, old: Column) -> Column:
    return ratio(new - old, old) * F.lit(100.0)


def net_pct(long_: Column, short: Column) -> Column:
    """Net position in percent, scaled before the division."""
    return ratio(F.lit(100.0) * (long_ - short), long_ + short)


def net_ratio_pct(long_: Column, short: Column) -> Column:
    """Net position in percent, scaled after the division.

    It may differ from net_pct in the last bit, which rounding can make visible, so both forms stay.
    """
    return ratio(long_ - short, long_ + short) * F.lit(100.0)


def skew_pct(call_long: Column, call_short: Column, put_long: Column, put_short: Column) -> Column:
    """Net calls minus net puts in percent of all four buckets."""
    net = (call_long - call_short) - (put_long - put_short)
    return ratio(F.lit(100.0) * net, call_long + call_short + put_long + put_short)
