"""Settings shared by every job."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

SERIES = "series_id"
DATE = "trade_date"
TARGET = "fwd_ret_20d"

# Feature column names by theme, as downstream users know them.
FEATURE_GROUPS = {
    "price_vol": [
        "nifty_close", "vix_close", "underlying_daily_vol", "futures_daily_vol", "applicable_daily_vol",
    ],
    "options_derived": ["pcr", "max_pain_dist_pct", "basis", "cost_of_carry", "fut_chng_oi_pct"],
    "breadth": [
        "advances", "declines", "adv_decl_ratio", "price_band_hits", "traded_value_cr", "num_trades",
        "market_cap_cr",
    ],
    "fii_dii_positioning": [
        "fii_fut_net_pct", "client_fut_net_pct", "fii_pe_net_pct", "fii_net_flow_cr", "dii_fut_net_pct",
        "pro_fut_net_pct", "fii_stk_fut_net_pct", "client_stk_fut_net_pct",
    ],
    "options_skew": [
        "fii_opt_skew_pct", "client_opt_skew_pct", "dii_opt_skew_pct", "pro_opt_skew_pct",
        "fii_vol_opt_skew_pct", "client_vol_opt_skew_pct",
    ],
    "vol_futures_flow": ["fii_vol_fut_net_pct", "client_vol_fut_net_pct", "pro_vol_fut_net_pct"],
    "divergence_stats": ["fii_client_divergence", "fii_stats_fut_net_pct", "fii_stats_oi_net_cr"],
    "engineered_deltas": [
        "vix_chg_5d", "pcr_chg_5d", "basis_chg_5d", "max_pain_dist_chg_5d", "vix_realized_spread",
        "fii_fut_net_chg_5d",
    ],
}
# Level columns that track time rather than the target; never model inputs.
CONFOUNDS = ["nifty_close", "market_cap_cr", "num_trades"]

BASE_FEATURES = sorted(
    name for names in FEATURE_GROUPS.values() for name in names if name not in CONFOUNDS
)
GARCH_FEATURES = ["garch_sigma", "garch_sigma_chg"]
FEATURE_VARIANTS = {
    "baseline_full": BASE_FEATURES,
    "baseline_full_garch": BASE_FEATURES + GARCH_FEATURES,
}


def variant_uses_garch(variant: str) -> bool:
    return variant.endswith("garch")


@dataclass(frozen=True)
class MarketNames:
    """Which rows of the source tables describe the modelled index (fixed values)."""

    price_index: str = "NIFTY 50"
    volatility_index: str = "INDIA VIX"
    ticker: str = "NIFTY"
    option_type: str = "IDO"
    future_type: str = "IDF"
    flow_instrument: str = "INDEX FUTURES"


@dataclass(frozen=True)
class GapPatch:
    """Replace `columns` on one day by the mean over `neighbours` when `guard` is NULL there.

    `series_id` None applies the patch to every series.
    """

    trade_date: str
    guard: str
    columns: tuple[str, ...]
    neighbours: tuple[str, ...]
    series_id: str | None = None


# The two known single-day holes in the published history.
KNOWN_GAPS = (
    GapPatch(
        "2021-03-31",
        "underlying_daily_vol",
        ("underlying_daily_vol", "futures_daily_vol", "applicable_daily_vol"),
        ("2021-03-30", "2021-04-01"),
    ),
    GapPatch(
        "2016-02-10",
        "fii_fut_net_pct",
        ("fii_fut_net_pct", "client_fut_net_pct", "fii_pe_net_pct"),
        ("2016-02-09", "2016-02-11"),
    ),
)


@dataclass(frozen=True)
class FoldSettings:
    """Walk-forward layout (fixed values). The embargo counts surviving rows, not days."""

    min_train_boundaries: int = 24
    embargo_rows: int = 20
    min_train_rows: int = 100
    min_test_rows: int = 5


@dataclass(frozen=True)
class GateSettings:
    """Promotion policy (fixed values, each overridable by the environment)."""

    min_mean_ic: float = 0.05
    min_positive_share: float = 0.55
    regression_tolerance: float = 0.0

    @classmethod
    def from_env(cls) -> "GateSettings":
        env = os.environ
        return cls(
            min_mean_ic=float(env.get("PROMOTION_MIN_MEAN_IC", cls.min_mean_ic)),
            min_positive_share=float(env.get("PROMOTION_MIN_POSITIVE_FOLD_PCT", cls.min_positive_share)),
            regression_tolerance=float(env.get("PROMOTION_REGRESSION_TOLERANCE", cls.regression_tolerance)),
        )


@dataclass(frozen=True)
class GarchParams:
    """One GARCH(1,1) parameter set; returns are in percent."""

    mu: float
    omega: float
    alpha: float
    beta: float
    nu: float | None = None


@dataclass(frozen=True)
class ModelSettings:
    """Tree-ensemble settings, in Spark ML terms."""

    kind: str
    params: dict = field(default_factory=dict)


# 300 trees or rounds of depth 4, seed 42, learning rate 0.03, 256 histogram bins; a leaf of the forest
# and of the second boosted family has 20 rows or more. Spark ML has no penalties on leaf values and no symmetric trees.
MODELS = {
    "random_forest": ModelSettings(
        "forest",
        {"numTrees": 300, "maxDepth": 4, "minInstancesPerNode": 20, "featureSubsetStrategy": "all", "maxBins": 256,
         "seed": 42},
    ),
    "xgboost": ModelSettings(
        "boosted",
        {"maxIter": 300, "maxDepth": 4, "stepSize": 0.03, "subsamplingRate": 0.8,
         "featureSubsetStrategy": "0.8", "maxBins": 256, "seed": 42},
    ),
    "lightgbm": ModelSettings(
        "boosted",
        {"maxIter": 300, "maxDepth": 4, "minInstancesPerNode": 20, "stepSize": 0.03, "subsamplingRate": 1.0,
         "featureSubsetStrategy": "0.8", "maxBins": 256, "seed": 42},
    ),
    "catboost": ModelSettings(
        "boosted",
        {"maxIter": 300, "maxDepth": 4, "stepSize": 0.03, "subsamplingRate": 0.8,
         "featureSubsetStrategy": "all", "maxBins": 256, "seed": 42},
    ),
}

REGISTERED_MODEL_NAME = "fwd_ret_20d_model"
PRODUCTION = "Production"
ARCHIVED = "Archived"
