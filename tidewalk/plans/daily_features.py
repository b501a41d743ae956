"""Market tables -> the 48-column daily feature frame, as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.config import KNOWN_GAPS, GapPatch, MarketNames
from tidewalk.operators import assembly, derivatives, participants, returns
from tidewalk.schemas import SNAPSHOT

DELTAS = {
    "vix_chg_5d": "vix_close",
    "pcr_chg_5d": "pcr",
    "basis_chg_5d": "basis",
    "max_pain_dist_chg_5d": "max_pain_dist_pct",
    "fii_fut_net_chg_5d": "fii_fut_net_pct",
}
# snapshot column -> participant_pivot column
PIVOT_COLUMNS = {
    "dii_fut_net_pct": "dii_oi_idx_fut_net_pct",
    "pro_fut_net_pct": "pro_oi_idx_fut_net_pct",
    "fii_opt_skew_pct": "fii_oi_idx_opt_skew_pct",
    "client_opt_skew_pct": "client_oi_idx_opt_skew_pct",
    "dii_opt_skew_pct": "dii_oi_idx_opt_skew_pct",
    "pro_opt_skew_pct": "pro_oi_idx_opt_skew_pct",
    "fii_stk_fut_net_pct": "fii_oi_stk_fut_net_pct",
    "client_stk_fut_net_pct": "client_oi_stk_fut_net_pct",
    "fii_vol_fut_net_pct": "fii_vol_idx_fut_net_pct",
    "client_vol_fut_net_pct": "client_vol_idx_fut_net_pct",
    "pro_vol_fut_net_pct": "pro_vol_idx_fut_net_pct",
    "fii_vol_opt_skew_pct": "fii_vol_idx_opt_skew_pct",
    "client_vol_opt_skew_pct": "client_vol_idx_opt_skew_pct",
}


def participant_columns(pivot: DataFrame, *carried: str) -> DataFrame:
    """The pivot under its snapshot names, with the divergence of foreign and client futures."""
    return pivot.select(
        "series_id", "trade_date",
        *[F.col(source).alias(name) for name, source in PIVOT_COLUMNS.items()],
        participants.divergence(F.col("fii_oi_idx_fut_net_pct"), F.col("client_oi_idx_fut_net_pct")).alias(
            "fii_client_divergence"
        ),
        *carried,
    )


def joined_features(tables: Mapping[str, DataFrame], names: MarketNames = MarketNames()) -> DataFrame:
    """Everything known about a day before any row-order logic: the star join.

    Spine and sides are one row per (series, day) when they join, by aggregation or by check. The windows that follow
    therefore see at most one row a day and series, whatever the raw tables hold.
    """
    options = derivatives.contracts_of(tables["options_analytics"], names.ticker, names.option_type)
    futures = derivatives.contracts_of(tables["futures_analytics"], names.ticker, names.future_type)
    breadth = tables["market_activity_breadth"].select(
        "series_id", "trade_date", "advances", "declines",
        assembly.breadth_ratio(F.col("advances"), F.col("declines")).alias("adv_decl_ratio"),
        "price_band_hits",
    )
    return assembly.star_join(
        returns.index_levels(
            tables["market_activity_index"], names.price_index, names.volatility_index
        ).withColumnRenamed("close", "nifty_close"),
        assembly.one_row_per_day(tables["fo_volatility"].filter(F.col("ticker") == names.ticker).drop("ticker")),
        assembly.one_row_per_day(breadth),
        assembly.one_row_per_day(tables["market_activity_summary"]),
        derivatives.put_call_ratio(options),
        derivatives.max_pain_distance(options),
        assembly.one_row_per_day(
            derivatives.nearest_expiry(futures).select(
                "series_id", "trade_date", "basis", "cost_of_carry", F.col("chng_oi_per").alias("fut_chng_oi_pct")
            )
        ),
        participant_columns(participants.participant_features(tables["participant_activity"]), *participants.ROLES),
        assembly.one_row_per_day(participants.flow_stats(tables["fii_stats"], names.flow_instrument)),
    )


def daily_features(
    tables: Mapping[str, DataFrame], names: MarketNames = MarketNames(), patches: Sequence[GapPatch] = KNOWN_GAPS
) -> DataFrame:
    """Joins first, by (series, day); then returns, patches and deltas in that order over one exchange and sort by
    series. Deltas see patched values."""
    frame = returns.forward_returns(joined_features(tables, names), price="nifty_close")
    frame = assembly.patch_gaps(frame, patches)
    frame = returns.lag_deltas(frame, DELTAS, rows=5)
    frame = frame.withColumn(
        "vix_realized_spread", returns.vol_spread(F.col("vix_close"), F.col("applicable_daily_vol"))
    )
    return frame.select(*SNAPSHOT.fieldNames())
