"""Every registered query: (spark, directory of the test tables) -> DataFrame.

Inputs are the proxies in `sources.proxies`. Fold, metric and decision queries run on the price series per order
priority; their predictions come from two closed-form predictors, so that both engines can compute them exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewalk.config import (
    BASE_FEATURES, FEATURE_VARIANTS, KNOWN_GAPS, REGISTERED_MODEL_NAME, TARGET, FoldSettings, GapPatch, GarchParams, MarketNames,
    variant_uses_garch,
)
from tidewalk.functions import round_f
from tidewalk.operators import (
    assembly, boosting, derivatives, folds, metrics, models, participants, returns, scoring, selection, tree_tables, volatility,
)
from tidewalk.plans import cross_validation, promotion, refresh
from tidewalk.plans.daily_features import DELTAS, daily_features, joined_features, participant_columns
from tidewalk.schemas import PREDICTIONS, RUNS, SNAPSHOT
from tidewalk.sources import proxies, tables
from tidewalk.streaming.scoring import read_stream, score_stream

NAMES = MarketNames()
MANY = 16
GARCH = GarchParams(mu=0.05, omega=2.0, alpha=0.1, beta=0.85)
GARCH_RIVALS = (
    GarchParams(mu=0.05, omega=2.0, alpha=0.1, beta=0.85, nu=8.0), GarchParams(mu=0.0, omega=50.0, alpha=0.2, beta=0.5, nu=5.0),
    GarchParams(mu=-0.1, omega=500.0, alpha=0.02, beta=0.4, nu=30.0),
)
TEST_GAPS = (
    GapPatch("1996-06-08", "fii_fut_net_pct", ("fii_fut_net_pct", "client_fut_net_pct", "fii_pe_net_pct"),
             ("1996-06-07", "1996-06-09")),
    GapPatch("1997-03-17", "adv_decl_ratio", ("adv_decl_ratio", "pcr"), ("1997-03-16", "1997-03-18")),
)
FIRST_DAYS = ("1996-06-08", "1997-06-30")
SHORT_FOLDS = FoldSettings(min_train_boundaries=12, embargo_rows=5, min_train_rows=20, min_test_rows=1)
LINE_INPUTS = ("close", "close_chg_5d")
LINE_MODELS = ("last_label", "moved_label", "least_squares")

QUERIES = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


# -- inputs -----------------------------------------------------------------------------------------------------

def _market(spark: SparkSession, sf_dir: str, n_series: int = 1) -> dict[str, DataFrame]:
    return proxies.market_tables(spark, sf_dir, n_series)


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returns.index_levels(
        proxies.market_activity_index(spark, sf_dir), NAMES.price_index, NAMES.volatility_index
    )


def _options(spark, sf_dir):
    return derivatives.contracts_of(proxies.options_analytics(spark, sf_dir), NAMES.ticker, NAMES.option_type)


def _futures(spark, sf_dir):
    return derivatives.contracts_of(proxies.futures_analytics(spark, sf_dir), NAMES.ticker, NAMES.future_type)


def _priority_features(spark, sf_dir):
    frame = returns.forward_returns(proxies.index_levels_by_priority(spark, sf_dir))
    return returns.lag_deltas(frame, {"close_chg_5d": "close"})


def _priority_frame(spark, sf_dir):
    return folds.model_frame(_priority_features(spark, sf_dir), [TARGET, "close_chg_5d"])


def _priority_boundaries(spark, sf_dir):
    return folds.monthly_boundaries(
        proxies.instruments_by_priority(spark, sf_dir), proxies.index_levels_by_priority(spark, sf_dir), NAMES.ticker
    )


def _priority_folds(spark, sf_dir):
    return folds.build_folds(_priority_frame(spark, sf_dir), _priority_boundaries(spark, sf_dir))


def _priority_ranges(spark, sf_dir):
    return folds.with_fold_ranges(_priority_frame(spark, sf_dir), _priority_folds(spark, sf_dir))


def _line_predictions(spark, sf_dir):
    """Per fold the newest training label, that label moved by one input, and a least-squares line on the input,
    rounded to six places. The first is constant in a fold, the second is not.

    Training sets are nested, so each fold's sums are running sums of what its newest rows add.
    """
    ranged = tables.materialise(_priority_ranges(spark, sf_dir), "ranged")
    y = F.col(TARGET)
    inputs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature_variant"), F.col(c).alias("x")) for c in LINE_INPUTS]))
    long = ranged.select("series_id", "trade_date", "first_train_fold", "last_fold", "test_fold", y.alias("y"), inputs)
    keys = ["series_id", "feature_variant", "fold_id"]
    sofar = Window.partitionBy("series_id", "feature_variant").orderBy("fold_id")
    x, y = F.col("x"), F.col("y")
    parts = {"n": F.lit(1.0), "sx": x, "sy": y, "sxy": x * y, "sxx": x * x}
    sums = (
        long.filter("first_train_fold is not null")
        .groupBy("series_id", "feature_variant", F.col("first_train_fold").alias("fold_id"))
        .agg(F.max_by(y, "trade_date").alias("newest"), *[F.sum(part).alias(name) for name, part in parts.items()])
        .withColumns({name: F.sum(name).over(sofar) for name in parts})
    )
    slope = F.expr("(n * sxy - sx * sy) / (n * sxx - sx * sx)")
    lines = sums.select(*keys, "newest", slope.alias("slope"),
                        ((F.col("sy") - slope * F.col("sx")) / F.col("n")).alias("intercept"))
    predicted = F.inline(F.array(
        F.struct(F.lit("last_label").alias("model_name"), F.col("newest").alias("raw")),
        F.struct(F.lit("moved_label").alias("model_name"), (F.col("newest") + x / F.lit(10000.0)).alias("raw")),
        F.struct(F.lit("least_squares").alias("model_name"), (F.col("intercept") + F.col("slope") * x).alias("raw")),
    ))
    return (
        long.filter("test_fold is not null").withColumnRenamed("test_fold", "fold_id").join(lines, keys)
        .select(*keys, "trade_date", y.alias("label"), predicted)
        .select(
            "model_name", "feature_variant", "series_id", "fold_id", "trade_date",
            round_f(F.col("raw"), 6).alias("prediction"), "label",
        )
    )


def _fold_results(spark, sf_dir):
    return metrics.fold_metrics(_line_predictions(spark, sf_dir))


def _summary(spark, sf_dir):
    """Summaries at six places: their sums are order-dependent in the last bits."""
    summary = metrics.summarize_folds(_fold_results(spark, sf_dir))
    doubles = [name for name, kind in summary.dtypes if kind == "double"]
    return selection.with_threshold_flag(summary.withColumns({c: round_f(F.col(c), 6) for c in doubles}))


def _challengers(spark, sf_dir):
    summary = tables.materialise(_summary(spark, sf_dir), "summary")
    return summary.withColumn("run_id", F.concat(F.lit("run-"), selection.experiment_key()))


def _registry(summary):
    """A past registry: experiments in alphabetical order as versions 1..n, the odd ones in Production."""
    version = F.row_number().over(Window.partitionBy("name").orderBy(*selection.EXPERIMENT))
    return (
        summary.withColumn("name", F.lit(REGISTERED_MODEL_NAME)).withColumn("version", version)
        .select(
            "name", "version",
            F.when(F.col("version") % 2 == 1, "Production").otherwise("Archived").alias("stage"),
            F.create_map(F.lit("mean_ic_pearson"), F.col("mean_ic_pearson").cast("string")).alias("tags"),
        )
    )


def _fold_windows(spark, sf_dir):
    frame = tables.materialise(_priority_frame(spark, sf_dir), "frame")
    built = tables.materialise(folds.build_folds(frame, _priority_boundaries(spark, sf_dir)), "folds")
    return volatility.training_windows(volatility.log_returns(frame, "close"), built)


def _snapshot_frame(spark, sf_dir):
    return folds.model_frame(daily_features(_market(spark, sf_dir)), [TARGET, *BASE_FEATURES])


# -- returns ----------------------------------------------------------------------------------------------------

@query
def forward_returns(spark, sf_dir):
    return returns.forward_returns(_levels(spark, sf_dir).select("series_id", "trade_date", "close"))


@query
def forward_returns_many_series(spark, sf_dir):
    return returns.forward_returns(proxies.index_levels_by_segment(spark, sf_dir))


@query
def next_row_position(spark, sf_dir):
    placed = returns.with_position(proxies.index_levels_by_priority(spark, sf_dir))
    days = returns.by_day()
    return placed.select(
        "series_id", "trade_date", "pos", *[F.lead("trade_date", n).over(days).alias(f"next_{n}") for n in (1, 5, 20)]
    )


# -- participants -----------------------------------------------------------------------------------------------

@query
def participant_base(spark, sf_dir):
    return participants.participant_base(proxies.participant_activity(spark, sf_dir))


@query
def participant_net_pct(spark, sf_dir):
    return participants.participant_net(participant_base(spark, sf_dir))


@query
def participant_pivot(spark, sf_dir):
    return participants.participant_pivot(proxies.participant_activity(spark, sf_dir))


@query
def role_net_pct(spark, sf_dir):
    return participants.role_net_pct(proxies.participant_activity(spark, sf_dir))


@query
def divergence(spark, sf_dir):
    return participant_columns(participant_pivot(spark, sf_dir)).select(
        "series_id", "trade_date", "fii_client_divergence"
    )


# -- derivatives ------------------------------------------------------------------------------------------------

@query
def put_call_ratio(spark, sf_dir):
    return derivatives.put_call_ratio(_options(spark, sf_dir))


@query
def top3_by_liquidity(spark, sf_dir):
    return derivatives.top_by_liquidity(_options(spark, sf_dir), 3).select(
        "series_id", "trade_date", "expiry", "open_interest", "liquidity_rank"
    )


@query
def max_pain_distance(spark, sf_dir):
    return derivatives.max_pain_distance(_options(spark, sf_dir), 3)


@query
def nearest_expiry_semi(spark, sf_dir):
    return derivatives.nearest_expiry(_futures(spark, sf_dir)).select(
        "series_id", "trade_date", "expiry", "basis", "cost_of_carry", "chng_oi_per"
    )


# -- assembly ---------------------------------------------------------------------------------------------------

@query
def breadth_ratio(spark, sf_dir):
    return proxies.market_activity_breadth(spark, sf_dir).select(
        "*", assembly.breadth_ratio(F.col("advances"), F.col("declines")).alias("adv_decl_ratio")
    )


@query
def fii_flow(spark, sf_dir):
    return participants.flow_stats(proxies.fii_stats(spark, sf_dir), NAMES.flow_instrument)


@query
def star_join(spark, sf_dir):
    return joined_features(_market(spark, sf_dir)).select(
        "series_id", "trade_date", "nifty_close", "vix_close", "pcr", "max_pain_dist_pct", "basis",
        "underlying_daily_vol", "advances", "num_trades", "fii_fut_net_pct", "fii_net_flow_cr",
    )


@query
def fill_columns(spark, sf_dir):
    """Replace one existing and add one absent column from the flows; days without flows keep what they had."""
    flows = participants.flow_stats(proxies.fii_stats(spark, sf_dir), NAMES.flow_instrument)
    return assembly.fill_columns(
        _levels(spark, sf_dir), flows,
        {"vix_close": F.col("fii_stats_fut_net_pct"), "fii_net_flow_cr": F.col("fii_net_flow_cr")},
    )


@query
def gap_patch(spark, sf_dir):
    columns = ["fii_fut_net_pct", "client_fut_net_pct", "fii_pe_net_pct", "adv_decl_ratio", "pcr"]
    return assembly.patch_gaps(joined_features(_market(spark, sf_dir, MANY)), TEST_GAPS).select(
        "series_id", "trade_date", *[round_f(F.col(c), 6).alias(c) for c in columns]
    )


@query
def lag5_deltas(spark, sf_dir):
    return returns.lag_deltas(joined_features(_market(spark, sf_dir)), DELTAS).select(
        "series_id", "trade_date", *DELTAS
    )


@query
def vol_spread(spark, sf_dir):
    joined = _levels(spark, sf_dir).join(proxies.fo_volatility(spark, sf_dir), ["series_id", "trade_date"], "left")
    spread = returns.vol_spread(F.col("vix_close"), F.col("applicable_daily_vol"))
    return joined.select("series_id", "trade_date", round_f(spread, 6).alias("vix_realized_spread"))


@query
def daily_features_single(spark, sf_dir):
    return daily_features(_market(spark, sf_dir))


@query
def daily_features_many_series(spark, sf_dir):
    return daily_features(_market(spark, sf_dir, MANY), patches=(*KNOWN_GAPS, *TEST_GAPS))


@query
def snapshot_roundtrip(spark, sf_dir):
    path = tables.new_working_path(spark, "snapshot")
    tables.write_snapshot(daily_features(_market(spark, sf_dir)), path)
    return tables.read_snapshot(spark, path)


@query
def snapshot_order(spark, sf_dir):
    """The keys of an ordered snapshot in the order in which they lie in its files."""
    path = tables.new_working_path(spark, "ordered")
    tables.write_ordered(joined_features(_market(spark, sf_dir, MANY)).select("series_id", "trade_date", "nifty_close"), path)
    return tables.in_file_order(spark.read.parquet(path)).select("series_id", "trade_date", "place")


@query
def daily_features_refreshed(spark, sf_dir):
    """Many series, written up to two days in the past one after the other and then brought up to date: a day before the
    neighbour of a patched day, and a year later."""
    path, patches = tables.new_working_path(spark, "monthly"), (*KNOWN_GAPS, *TEST_GAPS)
    market = _market(spark, sf_dir, MANY)

    def upto(day):
        return {n: t.where(F.col("trade_date") <= day) if "trade_date" in t.columns else t for n, t in market.items()}

    refresh.write_monthly(daily_features(upto(FIRST_DAYS[0]), patches=patches), path)
    for sources in (upto(FIRST_DAYS[1]), market):
        refresh.refresh(sources, path, patches=patches)
    return refresh.read_monthly(spark, path).drop(refresh.MONTH)


# -- boundaries and folds ---------------------------------------------------------------------------------------

@query
def monthly_boundaries(spark, sf_dir):
    return _priority_boundaries(spark, sf_dir)


@query
def model_frame(spark, sf_dir):
    return _snapshot_frame(spark, sf_dir).select("series_id", "trade_date", "pos", TARGET, "pcr", "basis_chg_5d")


@query
def asof_position(spark, sf_dir):
    placed = folds.boundary_positions(_priority_frame(spark, sf_dir), _priority_boundaries(spark, sf_dir))
    return placed.select("series_id", "expiry", (F.col("rows_up_to") - 1).alias("pos"), "embargo_date")


@query
def boundary_pairs(spark, sf_dir):
    placed = folds.boundary_positions(_priority_frame(spark, sf_dir), _priority_boundaries(spark, sf_dir))
    return folds.boundary_pairs(placed).select("series_id", "boundary_no", "expiry", "next_expiry")


@query
def walk_forward_folds(spark, sf_dir):
    return _priority_folds(spark, sf_dir)


@query
def folds_many_series(spark, sf_dir):
    levels = proxies.index_levels_by_segment(spark, sf_dir)
    frame = folds.model_frame(returns.forward_returns(levels, horizons=(5,)), ["fwd_ret_5d"])
    boundaries = levels.groupBy("series_id", F.trunc("trade_date", "month")).agg(F.max("trade_date").alias("expiry"))
    return folds.build_folds(frame, boundaries.select("series_id", "expiry"), SHORT_FOLDS)


@query
def fold_membership(spark, sf_dir):
    return folds.fold_membership(_priority_ranges(spark, sf_dir))


@query
def fold_sizes(spark, sf_dir):
    return folds.fold_sizes(folds.fold_membership(_priority_ranges(spark, sf_dir)))


@query
def fold_overlap(spark, sf_dir):
    return folds.fold_overlap(_priority_ranges(spark, sf_dir), _priority_folds(spark, sf_dir))


# -- metrics and decisions --------------------------------------------------------------------------------------

def _metric(spark, sf_dir, *names):
    return _fold_results(spark, sf_dir).select(
        *metrics.FOLD_KEYS, *[round_f(F.col(n), 6).alias(n) for n in names], "n_test"
    )


@query
def line_predictions(spark, sf_dir):
    return _line_predictions(spark, sf_dir)


@query
def near_constant(spark, sf_dir):
    day = F.col("trade_date")
    return _line_predictions(spark, sf_dir).groupBy(*metrics.FOLD_KEYS).agg(
        metrics.is_near_constant(F.col("prediction"), day).alias("flat_prediction"),
        metrics.is_near_constant(F.col("label"), day).alias("flat_label"),
    )


@query
def ic_pearson(spark, sf_dir):
    return _metric(spark, sf_dir, "ic_pearson")


@query
def ic_spearman(spark, sf_dir):
    return _metric(spark, sf_dir, "ic_spearman")


@query
def rmse_diracc(spark, sf_dir):
    return _metric(spark, sf_dir, "rmse", "dir_acc")


@query
def fold_summary(spark, sf_dir):
    return _summary(spark, sf_dir).drop("meets_threshold")


@query
def experiment_grid(spark, sf_dir):
    grid = selection.experiment_grid(_priority_folds(spark, sf_dir), LINE_MODELS, LINE_INPUTS)
    return grid.select(
        selection.experiment_key().alias("run_name"), *selection.EXPERIMENT, "series_id", "fold_id",
        F.date_format("test_start", "yyyy-MM-dd").alias("test_start"),
    )


def _numbered(ranked):
    """The rows with their place in the table: one task holds these few rows."""
    return ranked.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


@query
def rank_experiments(spark, sf_dir):
    return _numbered(selection.report(_summary(spark, sf_dir)))


@query
def report_csv(spark, sf_dir):
    path = tables.new_working_path(spark, "report-csv")
    ranked = selection.report(_summary(spark, sf_dir))
    tables.write_csv(ranked, path)
    return _numbered(spark.read.schema(ranked.schema).option("header", True).csv(path))


@query
def report_json(spark, sf_dir):
    path = tables.new_working_path(spark, "report-json")
    ranked = selection.report(_summary(spark, sf_dir))
    tables.write_json(ranked, path)
    return _numbered(tables.read_json(spark, path, ranked.schema))


@query
def run_log(spark, sf_dir):
    path = tables.new_working_path(spark, "run-log")
    results = tables.materialise(_fold_results(spark, sf_dir), "fold-results")
    summary = selection.with_threshold_flag(metrics.summarize_folds(results))
    variants = {name: [name] for name in LINE_INPUTS}
    folds_of = _priority_folds(spark, sf_dir)
    for _ in range(2):  # the second time replaces the first
        cross_validation.log_runs(
            results, summary, folds_of, variants, "cv", path, (*LINE_MODELS, "never_fitted"), {"places": 6}
        )
    return spark.read.schema(RUNS).parquet(f"{path}/runs").select(
        "run_id", *selection.EXPERIMENT, F.concat_ws(",", "feature_cols").alias("feature_cols"),
        F.col("params")["places"].alias("places"), "target", "n_features", "n_folds_requested", "status",
        "meets_threshold", "n_folds", round_f(F.col("mean_rmse"), 6).alias("mean_rmse"),
    )


@query
def winner(spark, sf_dir):
    return selection.pick_winner(_summary(spark, sf_dir)).select(
        *selection.EXPERIMENT, "mean_ic_pearson", "positive_fold_pct", "meets_threshold", "n_folds"
    )


@query
def production_lookup(spark, sf_dir):
    return selection.current_production(_registry(_summary(spark, sf_dir)))


@query
def promotion_gate(spark, sf_dir):
    challengers = _challengers(spark, sf_dir)
    verdicts = selection.promotion_gate(challengers, selection.current_production(_registry(challengers)))
    return verdicts.select(
        "run_id", "mean_ic_pearson", "production_ic", "passed", F.concat_ws("; ", "reasons").alias("reasons")
    )


@query
def registry_publish(spark, sf_dir):
    challengers = _challengers(spark, sf_dir)
    published = selection.publish(_registry(challengers), selection.pick_winner(challengers))
    return published.select(
        "name", "version", "stage", F.col("tags")["mean_ic_pearson"].cast("double").alias("tag_ic"),
        F.col("tags")["positive_fold_pct"].cast("double").alias("tag_share"), F.col("tags")["source_run_id"].alias("source_run_id"),
    )


# -- volatility -------------------------------------------------------------------------------------------------

def _rounded(path):
    return path.withColumns({c: round_f(F.col(c), 8) for c in ("garch_sigma", "garch_sigma_chg")})


@query
def log_returns(spark, sf_dir):
    frame = volatility.log_returns(_priority_frame(spark, sf_dir), "close")
    return frame.withColumn("log_ret", round_f(F.col("log_ret"), 10))


def _fixed_path(spark, sf_dir):
    windows = volatility.full_window(volatility.log_returns(_priority_frame(spark, sf_dir), "close"))
    return volatility.garch_path(volatility.garch_fit(windows, GARCH))


@query
def garch_path_fixed(spark, sf_dir):
    return _rounded(_fixed_path(spark, sf_dir))


def _test_rows(spark, sf_dir):
    return _priority_ranges(spark, sf_dir).filter("test_fold is not null").select(
        "series_id", F.col("test_fold").alias("fold_id"), "trade_date"
    )


@query
def garch_forecast_fixed(spark, sf_dir):
    fits = volatility.garch_fit(_fold_windows(spark, sf_dir), GARCH)
    return _rounded(volatility.garch_forecast(fits, _test_rows(spark, sf_dir)))


@query
def garch_join(spark, sf_dir):
    """Every training and test row of every fold with its volatility features; rows without any keep NULLs."""
    fits = tables.materialise(volatility.garch_fit(_fold_windows(spark, sf_dir), GARCH), "fixed-fits")
    features = volatility.garch_path(fits).drop("train_end").unionByName(volatility.garch_forecast(fits, _test_rows(spark, sf_dir)))
    members = folds.fold_membership(_priority_ranges(spark, sf_dir))
    return members.join(_rounded(features), ["series_id", "fold_id", "trade_date"], "left")


@query
def garch_fill(spark, sf_dir):
    requests = _priority_features(spark, sf_dir).select(
        "series_id", "trade_date", "close", F.lit(0.5).alias("garch_sigma"), F.lit(None).cast("double").alias("garch_sigma_chg")
    )
    return _rounded(scoring.fill_garch(requests, volatility.last_state(_fixed_path(spark, sf_dir))))


@query
def garch_fit(spark, sf_dir):
    """Fitted parameters of every walk-forward fold, with the size of the score there and the steps of the search."""
    fits = volatility.garch_fit(_fold_windows(spark, sf_dir))
    return fits.select(
        "series_id", "fold_id", "status", "mu", "omega", "alpha", "beta", "nu", "loglik", "score", "steps",
        F.size("sigma").alias("n_returns"),
    )


@query
def garch_fit_checks(spark, sf_dir):
    """What must hold for the fit of every fold: its returns are all used, its parameters are stationary, it is certified
    as a maximum, and its log likelihood is above those of three given parameter sets, which are told."""
    windows = tables.materialise(_fold_windows(spark, sf_dir), "windows")
    stationary = (F.col("omega") > 0) & (F.col("alpha") >= 0) & (F.col("beta") >= 0) & (F.col("alpha") + F.col("beta") < 1)
    rivals = [f"loglik_{n}" for n in range(1, len(GARCH_RIVALS) + 1)]
    fits = volatility.garch_fit(windows).join(volatility.garch_loglik(windows, GARCH_RIVALS), ["series_id", "fold_id", "train_end"])
    return fits.select(
        "series_id", "fold_id", F.size("sigma").cast("long").alias("n_returns"),
        (stationary & (F.col("nu") > 2) & F.col("loglik").isNotNull()).alias("sound"),
        (F.col("status") == "ok").alias("certified"), (F.col("loglik") >= F.greatest(*rivals)).alias("beats_all"),
        *[round_f(F.col(name), 6).alias(name) for name in rivals],
    )


# -- models and scoring -----------------------------------------------------------------------------------------

def _walk_forward(spark, sf_dir, with_garch):
    """Every fold of the daily features under the default settings."""
    snapshot = tables.materialise(daily_features(_market(spark, sf_dir)), "snapshot")
    boundaries = folds.monthly_boundaries(proxies.instruments(spark, sf_dir), snapshot, NAMES.ticker)
    return cross_validation.prepare(snapshot, boundaries, (TARGET, *BASE_FEATURES), with_garch=with_garch)


def _forest_cv(spark, sf_dir, variant):
    work = _walk_forward(spark, sf_dir, variant_uses_garch(variant))
    predicted = cross_validation.predictions(work, ["random_forest"], {variant: FEATURE_VARIANTS[variant]})
    return metrics.fold_metrics(spark.createDataFrame([], PREDICTIONS) if predicted is None else predicted)


@query
def cv_random_forest(spark, sf_dir):
    """The forest with its published settings over all folds."""
    return _forest_cv(spark, sf_dir, "baseline_full")


@query
def cv_random_forest_garch(spark, sf_dir):
    """The same with the folds' volatility."""
    return _forest_cv(spark, sf_dir, "baseline_full_garch")


def _audited(spark, scored, rows, model, columns):
    """The scored rows with the difference to scores by the model's table of nodes."""
    keys, levels = ["series_id", "trade_date"], model.stages[-1].getMaxDepth()
    nodes = tables.materialise(tree_tables.node_table(spark, model), "nodes")
    valid, _ = scoring.split_valid(rows, columns)
    return tree_tables.scoring_difference(scored, tree_tables.score_by_nodes(valid, nodes, columns, keys, levels), keys)


def _boosted(spark, sf_dir, name):
    """One fit of a boosted family with its published settings on all history, and its score of every complete day,
    told as the difference to the score by the table of its nodes."""
    snapshot = tables.materialise(daily_features(_market(spark, sf_dir)), "snapshot")
    model = models.refit(folds.model_frame(snapshot, [TARGET, *BASE_FEATURES]), name, BASE_FEATURES)
    scored = scoring.score(snapshot, model, name, "baseline_full", BASE_FEATURES)
    return _audited(spark, scored, snapshot, model, BASE_FEATURES)


@query
def refit_xgboost(spark, sf_dir):
    return _boosted(spark, sf_dir, "xgboost")


@query
def refit_lightgbm(spark, sf_dir):
    return _boosted(spark, sf_dir, "lightgbm")


@query
def refit_catboost(spark, sf_dir):
    return _boosted(spark, sf_dir, "catboost")


def _fitted(spark, sf_dir):
    snapshot = tables.materialise(daily_features(_market(spark, sf_dir)), "snapshot")
    frame = promotion.training_frame(
        folds.model_frame(snapshot, [TARGET, *BASE_FEATURES]), "baseline_full_garch"
    )
    columns = FEATURE_VARIANTS["baseline_full_garch"]
    model = models.refit(frame, "random_forest", columns)
    return snapshot, model, columns, tables.materialise(promotion.serving_state(snapshot), "garch-state")


@query
def refit_and_score(spark, sf_dir):
    """The forest with volatility, fitted on all history: its scores' difference to those by the table of its nodes."""
    snapshot, model, columns, state = _fitted(spark, sf_dir)
    scored = scoring.score(snapshot, model, "random_forest", "baseline_full_garch", columns, state)
    return _audited(spark, scored, scoring.fill_garch(snapshot, state), model, columns)


@query
def stream_score(spark, sf_dir):
    """The same of rows that a stream scores from files and writes to files."""
    snapshot, model, columns, state = _fitted(spark, sf_dir)
    inbox, base = (tables.new_working_path(spark, label) for label in ("inbox", "stream"))
    tables.write_snapshot(snapshot, inbox)
    rows = read_stream(spark, inbox, SNAPSHOT)
    running = score_stream(
        rows, model, "random_forest", "baseline_full_garch", columns, f"{base}/scored", f"{base}/rejected",
        f"{base}/checkpoint", state,
    )
    for stream in running:
        stream.awaitTermination()
    return _audited(spark, spark.read.parquet(f"{base}/scored"), scoring.fill_garch(snapshot, state), model, columns)


@query
def missing_features(spark, sf_dir):
    """Daily rows as requests: complete on the first of a month, not a number in one feature on the 13th."""
    day = F.dayofmonth("trade_date")
    requests = daily_features(_market(spark, sf_dir))
    filled = requests.withColumns({
        c: F.when(day == 1, F.coalesce(F.col(c).cast("double"), F.lit(0.1))).otherwise(F.col(c)) for c in BASE_FEATURES
    }).withColumn("basis", F.when(day == 13, float("nan")).otherwise(F.col("basis")))
    checked = scoring.with_missing(filled, BASE_FEATURES)
    return checked.select("series_id", "trade_date", F.concat_ws(",", "missing").alias("missing"))


@query
def sample_row(spark, sf_dir):
    return scoring.sample_complete_row(daily_features(_market(spark, sf_dir)), BASE_FEATURES, seed=7)


# -- fits that have a closed form: one split of one feature with few values ---------------------------------------

PENALTIES = (25.0, 1000.0)  # large enough to show in the sums of many rows
STUMP = {
    "random_forest": {"numTrees": 1, "maxDepth": 1, "minInstancesPerNode": 1, "bootstrap": False},
    "xgboost": {"maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"},
    "lightgbm": {"maxIter": 1, "maxDepth": 1, "minInstancesPerNode": 1, "featureSubsetStrategy": "all"},
    "catboost": {"maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0},
}


def _stump_frame(spark, sf_dir):
    """The priority frame with a feature of twelve values, and the columns that runs expect."""
    return _priority_frame(spark, sf_dir).withColumn("month", F.month("trade_date").cast("double"))


@query
def stump_cv(spark, sf_dir):
    """Every family as one split, over all folds of all series: the fits' predictions."""
    frame = _stump_frame(spark, sf_dir)
    built = tables.materialise(folds.build_folds(frame, _priority_boundaries(spark, sf_dir)), "folds")
    ranged = tables.materialise(folds.with_fold_ranges(frame, built), "ranged", ["trade_date"])
    starts = cross_validation.WalkForward(ranged, built, None).boundaries()
    found = [
        models.run_experiments(ranged, starts, [(name, "month", ["month"])], overrides=settings)
        for name, settings in STUMP.items()
    ]
    predicted = reduce(DataFrame.unionByName, [f for f in found if f is not None], spark.createDataFrame([], PREDICTIONS))
    return predicted.select(*metrics.FOLD_KEYS, "trade_date", round_f(F.col("prediction"), 6).alias("prediction"))


def _stump_saved(spark, sf_dir):
    """One split fitted on all history, saved and loaded again, and the requests."""
    frame = tables.materialise(_stump_frame(spark, sf_dir), "refit")
    path = tables.new_working_path(spark, "artifact")
    models.refit(frame, "random_forest", ["month"], STUMP["random_forest"]).write().save(path)
    requests = _priority_features(spark, sf_dir).select(
        "series_id", "trade_date", F.when(F.dayofmonth("trade_date") != 13, F.month("trade_date").cast("double")).alias("month")
    )
    return PipelineModel.load(path), requests


def _scores(scored):
    return scored.select("series_id", "trade_date", round_f(F.col("prediction"), 6).alias("prediction"))


@query
def stump_refit_score(spark, sf_dir):
    model, requests = _stump_saved(spark, sf_dir)
    return _scores(scoring.score(requests, model, "random_forest", "month", ["month"]))


@query
def penalised_rounds(spark, sf_dir):
    """Two rounds of penalised single splits, scored by the table of their nodes."""
    keys, settings = ["series_id", "trade_date"], boosting.Boosting(rounds=2, depth=1, step=0.5, l1=PENALTIES[0], l2=PENALTIES[1],
                                                                    row_share=1.0, column_share=1.0)
    nodes = tables.materialise(boosting.fit_boosted(_stump_frame(spark, sf_dir), ["month"], keys, settings), "nodes")
    requests = _priority_features(spark, sf_dir).select(*keys, F.month("trade_date").cast("double").alias("month"))
    return _scores(tree_tables.score_by_nodes(requests, nodes, ["month"], keys, levels=1))


@query
def stump_stream(spark, sf_dir):
    model, requests = _stump_saved(spark, sf_dir)
    inbox, base = (tables.new_working_path(spark, label) for label in ("inbox", "stream"))
    requests.write.parquet(inbox)
    rows = read_stream(spark, inbox, requests.schema)
    running = score_stream(
        rows, model, "random_forest", "month", ["month"], f"{base}/scored", f"{base}/rejected", f"{base}/checkpoint"
    )
    for stream in running:
        stream.awaitTermination()
    return _scores(spark.read.parquet(f"{base}/scored"))
