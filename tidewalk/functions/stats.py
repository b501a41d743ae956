"""Aggregate and window expressions for forecast scoring."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from tidewalk.functions.numeric import ratio

# Tolerances of the near-constant test.
ABS_TOL = 1e-8
REL_TOL = 1e-5


def is_near_constant(x: Column, order: Column) -> Column:
    """True when every x lies within tolerance of the first x by `order`; one pass, mergeable."""
    first = F.min_by(x, order)
    tol = F.lit(ABS_TOL) + F.lit(REL_TOL) * F.abs(first)
    return (F.max(x) - first <= tol) & (first - F.min(x) <= tol)


def pearson(x: Column, y: Column) -> Column:
    """Correlation from central moments; NULL instead of an error on a constant side."""
    return ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def average_rank(x: Column, group: WindowSpec) -> Column:
    """1-based rank of x in its group, ties sharing their mean rank."""
    ordered = group.orderBy(x)
    peers = ordered.rangeBetween(0, 0)
    return F.rank().over(ordered) + (F.count(F.lit(1)).over(peers) - 1) / F.lit(2.0)
