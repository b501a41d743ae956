"""Positioning of market participants.

The table has one row per participant, metric, asset class, option side and direction; a *cell* is one such combination
of a participant, a metric and a bucket. Day-level measures come from one aggregation by (series, day) with a sum per
cell, so the shuffle carries one row per day and map task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewalk.functions import net_pct, net_ratio_pct, round_f, skew_pct

DAY = ("series_id", "trade_date")
PARTICIPANTS = ("FII", "Client", "DII", "Pro")
METRICS = ("OI", "VOL")
# bucket -> (asset class, option side)
INSTRUMENTS = {
    "idx_fut": ("INDEX", "NA"),
    "stk_fut": ("STOCK", "NA"),
    "idx_ce": ("INDEX", "CE"),
    "idx_pe": ("INDEX", "PE"),
}
DIRECTIONS = ("long", "short")
BUCKETS = [f"{instrument}_{direction}" for instrument in INSTRUMENTS for direction in DIRECTIONS]
# measure -> the buckets it nets
MEASURES = {
    "idx_fut_net_pct": BUCKETS[0:2],
    "stk_fut_net_pct": BUCKETS[2:4],
    "idx_opt_skew_pct": BUCKETS[4:8],
}
# measure -> the (participant, metric) pairs it is reported for
REPORTED = {
    "idx_fut_net_pct": [
        ("FII", "OI"), ("Client", "OI"), ("DII", "OI"), ("Pro", "OI"),
        ("FII", "VOL"), ("Client", "VOL"), ("Pro", "VOL"),
    ],
    "idx_opt_skew_pct": [
        ("FII", "OI"), ("Client", "OI"), ("DII", "OI"), ("Pro", "OI"), ("FII", "VOL"), ("Client", "VOL"),
    ],
    "stk_fut_net_pct": [("FII", "OI"), ("Client", "OI")],
}
# snapshot column -> the single role it nets
ROLES = {
    "fii_fut_net_pct": ("FII", "OI", "idx_fut"),
    "client_fut_net_pct": ("Client", "OI", "idx_fut"),
    "fii_pe_net_pct": ("FII", "OI", "idx_pe"),
}


def _position(column: str, values: Iterable[str]) -> str:
    return f"case {column} " + " ".join(f"when '{v}' then {i}" for i, v in enumerate(values)) + " end"


def _bucket_no() -> str:
    """SQL for the position in BUCKETS, NULL outside it."""
    instrument = " ".join(
        f"when asset_class = '{asset}' and option_side = '{side}' then {i}"
        for i, (asset, side) in enumerate(INSTRUMENTS.values())
    )
    return f"(case {instrument} end) * 2 + {_position('direction', DIRECTIONS)}"


def participant_base(df: DataFrame) -> DataFrame:
    """Contracts in eight buckets per day, participant and metric; an empty bucket counts 0."""
    keys = [*DAY, "participant_type", "metric_type"]
    return (
        df.select(*keys, "contracts", F.expr(_bucket_no()).alias("bucket"))
        .groupBy(*keys)
        .agg(*[F.expr(f"sum(if(bucket = {i}, contracts, 0)) as {name}") for i, name in enumerate(BUCKETS)])
    )


def participant_net(base: DataFrame) -> DataFrame:
    """Net futures positions and option skew in percent, from `participant_base`."""
    measures = [_measure(name, *[F.col(b) for b in buckets]).alias(name) for name, buckets in MEASURES.items()]
    return base.select(*DAY, "participant_type", "metric_type", *measures)


def _measure(name: str, *buckets: Column) -> Column:
    return round_f((skew_pct if name == "idx_opt_skew_pct" else net_pct)(*buckets), 2)


def _cell(who: str, metric: str, bucket: str) -> str:
    return f"{who}_{metric}_{bucket}".lower()


def _cells_by_day(df: DataFrame, cells: Iterable[tuple[str, str, str]]) -> DataFrame:
    """One row per day with a sum per cell, NULL where the cell has no row."""
    number = (
        f"{_position('participant_type', PARTICIPANTS)} * 16 + {_position('metric_type', METRICS)} * 8 + {_bucket_no()}"
    )
    sums = [
        F.expr(
            f"sum(contracts) filter (where cell = "
            f"{PARTICIPANTS.index(who) * 16 + METRICS.index(metric) * 8 + BUCKETS.index(bucket)}) "
            f"as {_cell(who, metric, bucket)}"
        )
        for who, metric, bucket in cells
    ]
    return df.select(*DAY, "contracts", F.expr(number).alias("cell")).groupBy(*DAY).agg(*sums)


def _reported_cells() -> list[tuple[str, str, str]]:
    return list(dict.fromkeys(
        (who, metric, bucket)
        for measure, pairs in REPORTED.items() for who, metric in pairs for bucket in MEASURES[measure]
    ))


def _role_cells() -> list[tuple[str, str, str]]:
    return [(who, metric, f"{i}_{d}") for who, metric, i in ROLES.values() for d in DIRECTIONS]


def _reported() -> list[Column]:
    """Measures with empty cells as 0. A participant absent that day nets 0 of 0, which is NULL."""
    return [
        _measure(
            measure, *[F.expr(f"coalesce({_cell(who, metric, bucket)}, 0L)") for bucket in MEASURES[measure]]
        ).alias(f"{who}_{metric}".lower() + f"_{measure}")
        for measure, pairs in REPORTED.items() for who, metric in pairs
    ]


def _roles() -> list[Column]:
    """Single-role nets, NULL unless both directions were reported, so a one-sided day is not +-100."""
    return [
        round_f(net_ratio_pct(*[F.col(_cell(who, metric, f"{i}_{d}")) for d in DIRECTIONS]), 2).alias(name)
        for name, (who, metric, i) in ROLES.items()
    ]


def participant_pivot(df: DataFrame) -> DataFrame:
    """One row per day with a column per reported (participant, metric, measure)."""
    return _cells_by_day(df, _reported_cells()).select(*DAY, *_reported())


def role_net_pct(df: DataFrame) -> DataFrame:
    """Net open interest of single roles: one conditional aggregation instead of six joins of the table to itself."""
    roles = F.col("participant_type").isin("FII", "Client") & (F.col("asset_class") == "INDEX")
    return _cells_by_day(df.filter((F.col("metric_type") == "OI") & roles), _role_cells()).select(*DAY, *_roles())


def participant_features(df: DataFrame) -> DataFrame:
    """`participant_pivot` and `role_net_pct` side by side from one pass over the table."""
    cells = dict.fromkeys([*_reported_cells(), *_role_cells()])
    return _cells_by_day(df, cells).select(*DAY, *_reported(), *_roles())


def divergence(a: Column, b: Column) -> Column:
    return round_f(a - b, 2)


def flow_stats(df: DataFrame, instrument: str) -> DataFrame:
    """Net flow, net contracts and open-interest amount of one instrument per day."""
    c = F.col
    return df.filter(c("instrument") == instrument).select(
        *DAY,
        round_f(c("buy_amount_cr") - c("sell_amount_cr"), 2).alias("fii_net_flow_cr"),
        round_f(net_ratio_pct(c("buy_contracts"), c("sell_contracts")), 2).alias("fii_stats_fut_net_pct"),
        c("oi_amount_cr").cast("double").alias("fii_stats_oi_net_cr"),
    )
