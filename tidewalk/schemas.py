"""Declared schemas: no source is ever read with inference."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "date": T.DateType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "doubles": T.ArrayType(T.DoubleType()),
    "strings": T.ArrayType(T.StringType()),
    "tags": T.MapType(T.StringType(), T.StringType()),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind], True) for name, kind in columns.items()])


SOURCE_TABLES = {
    "market_activity_index": _schema(series_id="string", trade_date="date", index_name="string", close="double"),
    "participant_activity": _schema(
        series_id="string", trade_date="date", participant_type="string", metric_type="string",
        asset_class="string", option_side="string", direction="string", contracts="long",
    ),
    "options_analytics": _schema(
        series_id="string", trade_date="date", ticker="string", instrument_type="string", expiry="date",
        max_pain="double", pe_oi="long", ce_oi="long", underlying_price="double",
    ),
    "futures_analytics": _schema(
        series_id="string", trade_date="date", ticker="string", instrument_type="string", expiry="date",
        basis="double", cost_of_carry="double", chng_oi_per="double",
    ),
    "fo_volatility": _schema(
        series_id="string", trade_date="date", ticker="string", underlying_daily_vol="double",
        futures_daily_vol="double", applicable_daily_vol="double",
    ),
    "market_activity_breadth": _schema(
        series_id="string", trade_date="date", advances="long", declines="long", price_band_hits="long",
    ),
    "market_activity_summary": _schema(
        series_id="string", trade_date="date", traded_value_cr="double", num_trades="long", market_cap_cr="double",
    ),
    "fii_stats": _schema(
        series_id="string", trade_date="date", instrument="string", buy_amount_cr="double",
        sell_amount_cr="double", buy_contracts="long", sell_contracts="long", oi_amount_cr="double",
    ),
    "instruments": _schema(series_id="string", ticker="string", expiry="date"),
}

# The feature snapshot's columns, in published order (series_id is ours).
SNAPSHOT = _schema(
    series_id="string", trade_date="date", nifty_close="double", fwd_ret_1d="double", fwd_ret_5d="double",
    fwd_ret_20d="double", up_1d="int", vix_close="double", pcr="double", max_pain_dist_pct="double",
    basis="double", cost_of_carry="double", fut_chng_oi_pct="double", underlying_daily_vol="double",
    futures_daily_vol="double", applicable_daily_vol="double", advances="long", declines="long",
    adv_decl_ratio="double", price_band_hits="long", traded_value_cr="double", num_trades="long",
    market_cap_cr="double", fii_fut_net_pct="double", client_fut_net_pct="double", fii_pe_net_pct="double",
    fii_net_flow_cr="double", dii_fut_net_pct="double", pro_fut_net_pct="double", fii_opt_skew_pct="double",
    client_opt_skew_pct="double", dii_opt_skew_pct="double", pro_opt_skew_pct="double",
    fii_stk_fut_net_pct="double", client_stk_fut_net_pct="double", fii_vol_fut_net_pct="double",
    client_vol_fut_net_pct="double", pro_vol_fut_net_pct="double", fii_vol_opt_skew_pct="double",
    client_vol_opt_skew_pct="double", fii_client_divergence="double", fii_stats_fut_net_pct="double",
    fii_stats_oi_net_cr="double", vix_chg_5d="double", pcr_chg_5d="double", basis_chg_5d="double",
    max_pain_dist_chg_5d="double", vix_realized_spread="double", fii_fut_net_chg_5d="double",
)

BOUNDARIES = _schema(series_id="string", expiry="date")
FOLDS = _schema(
    series_id="string", fold_id="int", train_end="date", test_start="date", test_end="date",
    embargo_date="date", n_train="long", n_test="long",
)
GARCH_FIT = _schema(
    status="string", mu="double", omega="double", alpha="double", beta="double", nu="double", loglik="double",
    score="double", steps="int", next_variance="double", sigma="doubles",
)
PREDICTIONS = _schema(
    model_name="string", feature_variant="string", series_id="string", fold_id="int", trade_date="date",
    prediction="double", label="double",
)
FIT_OUTCOMES = _schema(
    model_name="string", feature_variant="string", boundary="date", status="string", finished="timestamp",
)
FOLD_RESULTS = _schema(
    run_id="string", model_name="string", feature_variant="string", series_id="string", fold="int",
    test_start="string", ic_pearson="double", ic_spearman="double", rmse="double", dir_acc="double", n_test="long",
)
RUNS = _schema(
    run_id="string", model_name="string", feature_variant="string", feature_cols="strings", params="tags",
    target="string", n_features="int", n_folds_requested="long", status="string", meets_threshold="boolean", n_folds="long", mean_ic_pearson="double", mean_ic_spearman="double",
    ic_t_stat="double", positive_fold_pct="double", mean_rmse="double", mean_dir_acc="double",
)
CHALLENGER = _schema(
    run_id="string", model_name="string", feature_variant="string", feature_cols="strings",
    mean_ic_pearson="double", positive_fold_pct="double", meets_threshold="boolean", n_folds="long",
)
REGISTRY = _schema(name="string", version="int", stage="string", tags="tags")
ARTIFACT = _schema(
    model_name="string", feature_variant="string", feature_cols="strings", target="string", uses_garch="boolean",
    train_rows="long", n_features="int", params="tags", walk_forward_mean_ic_pearson="double", walk_forward_positive_fold_pct="double",
    walk_forward_n_folds="long", source_run_id="string",
)
