import datetime as dt

import numpy as np
import pytest
from conftest import business_days, month_ends, rows
from pyspark.sql import functions as F

from tidewalk import schemas
from tidewalk.config import BASE_FEATURES, FEATURE_VARIANTS, GARCH_FEATURES, MODELS, REGISTERED_MODEL_NAME, TARGET, GateSettings
from tidewalk.operators import models, scoring, selection, tree_tables
from tidewalk.plans import cross_validation, promotion
from tidewalk.sources import commits, tables
from tidewalk.streaming.scoring import read_stream, score_stream

FEATURES = ["x1", "x2"]
VARIANTS = {"plain": FEATURES, "plain_garch": [*FEATURES, *GARCH_FEATURES]}
QUICK = {"numTrees": 5, "maxBins": 32}


@pytest.fixture(scope="module")
def snapshot(spark):
    """1,000 days of one series whose target follows x1; the last 20 rows have no target."""
    rng = np.random.default_rng(0)
    days = business_days(1000)
    x1, x2 = rng.normal(size=1000), rng.normal(size=1000)
    price = 100 * np.exp(np.cumsum(rng.standard_t(6, size=1000)) / 100)
    data = [
        ("A", d, float(p), float(a), float(b), float(2 * a + 0.1 * b) if i < 980 else None)
        for i, (d, p, a, b) in enumerate(zip(days, price, x1, x2))
    ]
    df = spark.createDataFrame(
        data, "series_id string, trade_date date, nifty_close double, x1 double, x2 double, fwd_ret_20d double"
    )
    return tables.materialise(df, "test-snapshot")


@pytest.fixture(scope="module")
def work(spark, snapshot):
    bounds = spark.createDataFrame([("A", e) for e in month_ends(60)], "series_id string, expiry date")
    return cross_validation.prepare(snapshot, bounds, (TARGET, *FEATURES))


def test_feature_lists():
    assert len(BASE_FEATURES) == 40 and BASE_FEATURES == sorted(BASE_FEATURES)
    assert FEATURE_VARIANTS["baseline_full_garch"] == BASE_FEATURES + GARCH_FEATURES
    assert set(BASE_FEATURES) <= set(schemas.SNAPSHOT.fieldNames()) and len(schemas.SNAPSHOT) == 49


def test_estimators_carry_the_published_settings(spark):
    assert set(MODELS) == {"random_forest", "xgboost", "lightgbm", "catboost"}
    forest = models.make_estimator("random_forest")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (300, 4, 20, 42)
    assert all(models.make_estimator(name).getMaxBins() == 256 for name in MODELS)
    assert models.make_estimator("lightgbm").getMinInstancesPerNode() == 20
    boosted = models.make_estimator("xgboost", {"maxIter": 2})
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getSubsamplingRate()) == (2, 0.03, 0.8)
    with pytest.raises(ValueError, match="unknown model"):
        models.make_estimator("linear")


@pytest.fixture(scope="module")
def starts(work):
    return work.boundaries()


def test_garch_variant_loses_its_first_two_training_rows_only(work, starts):
    plain = models.fold_rows(work.ranged, starts[0])
    garch = [
        models.usable_rows(side, VARIANTS["plain_garch"]) for side in models.fold_rows(work.ranged, starts[0], work.garch)
    ]
    assert garch[0].count() == plain[0].count() - 2
    assert garch[1].count() == plain[1].count() == garch[1].na.drop(subset=GARCH_FEATURES).count()


def test_no_training_row_is_after_the_embargo(work, starts):
    fold = work.folds.filter("fold_id = 3").first()
    train, test = models.fold_rows(work.ranged, starts[3])
    span = train.agg(F.max("trade_date")).first()[0], test.agg(F.min("trade_date")).first()[0]
    assert span[0] == fold.embargo_date and span[1] > fold.test_start


def test_series_of_unequal_length_share_a_boundary_without_lookahead(spark, snapshot):
    """B starts a year later, so its fold 0 is not A's fold 0; pooling by boundary keeps training before testing."""
    late = snapshot.filter("trade_date >= '2017-01-01'").withColumn("series_id", F.lit("B"))
    ends = [("A", e) for e in month_ends(60)] + [("B", e) for e in month_ends(60)[12:]]
    bounds = spark.createDataFrame(ends, "series_id string, expiry date")
    both = cross_validation.prepare(snapshot.union(late), bounds, (TARGET, *FEATURES), with_garch=False)
    shared = both.folds.filter("series_id = 'B'").first().train_end
    assert both.folds.filter(F.col("train_end") == shared).select("fold_id").distinct().count() == 2
    train, test = models.fold_rows(both.ranged, shared)
    ends = {r[0]: r[1] for r in train.groupBy("series_id").agg(F.max("trade_date")).collect()}
    assert set(ends) == {"A", "B"} and max(ends.values()) < shared < test.agg(F.min("trade_date")).first()[0]
    members = both.folds.filter(F.col("train_end") == shared).agg(F.sum("n_train"), F.sum("n_test")).first()
    assert (train.count(), test.count()) == tuple(members)


def test_failed_volatility_makes_the_fold_vanish(spark, work, starts):
    none = work.garch.withColumns({c: F.lit(None).cast("double") for c in GARCH_FEATURES})
    sides = models.fold_rows(work.ranged, starts[0], none)
    assert models.run_fold(*sides, "random_forest", "v", VARIANTS["plain_garch"], QUICK) is None
    result = models.run_experiments(
        work.ranged, starts[:2], [("random_forest", "v", VARIANTS["plain_garch"])], none, QUICK
    )
    assert result is None


def test_a_series_without_volatility_leaves_the_others_in(spark, snapshot, work, starts):
    """Series B has no volatility: the base experiment scores both, the other one A only."""
    other = work.ranged.withColumn("series_id", F.lit("B"))
    both = work.ranged.unionByName(other)
    experiments = [("random_forest", name, columns) for name, columns in VARIANTS.items()]
    got = models.run_experiments(both, starts[:1], experiments, work.garch, QUICK)
    seen = {(r.feature_variant, r.series_id) for r in got.select("feature_variant", "series_id").distinct().collect()}
    assert seen == {("plain", "A"), ("plain", "B"), ("plain_garch", "A")}


def test_series_with_other_calendars_are_left_out_of_both_variants(spark, snapshot, work, starts):
    """B's folds start on other days, so a fit at A's boundary trains on A alone, with and without volatility."""
    other = snapshot.withColumn("series_id", F.lit("B"))
    middle = [(name, e if name == "A" else e.replace(day=15)) for name in "AB" for e in month_ends(60)]
    two = cross_validation.prepare(
        snapshot.unionByName(other), spark.createDataFrame(middle, "series_id string, expiry date"), (TARGET, *FEATURES)
    )
    train, test = models.fold_rows(two.ranged, starts[0], two.garch)
    for side in (train, test):
        for columns in VARIANTS.values():
            assert {r[0] for r in models.usable_rows(side, columns).select("series_id").distinct().collect()} == {"A"}


def test_a_failed_fit_is_recorded_and_repeated_alone(spark, work, starts, tmp_path, monkeypatch):
    experiments = [("random_forest", "plain", FEATURES), ("random_forest", "other", FEATURES)]
    plain, calls = models.run_fold, []

    def broken(train, test, name, variant, *rest):
        calls.append(variant)
        if variant == "other" and len(calls) < 3:
            raise ValueError("no fit")
        return plain(train, test, name, variant, *rest)

    monkeypatch.setattr(models, "run_fold", broken)
    args = (work.ranged, starts[:1], experiments, None, QUICK)
    first = models.run_experiments(*args, in_flight=1, folder=str(tmp_path))
    assert {r.feature_variant for r in first.collect()} == {"plain"}
    status = {r.feature_variant: r.status for r in models.outcomes(spark, str(tmp_path)).collect()}
    assert status == {"plain": "fitted", "other": "failed: no fit"}
    again = models.run_experiments(*args, in_flight=1, folder=str(tmp_path))
    assert calls == ["plain", "other", "other"]
    assert {r.feature_variant for r in again.collect()} == {"plain", "other"}
    assert models.run_experiments(*args, in_flight=1, folder=str(tmp_path)).count() == again.count() and len(calls) == 3


def one_fit_fails(monkeypatch, which=1):
    """The fit that is started after `which` others fails, whatever is fitted; gives the list of fits started."""
    plain, calls = models.run_fold, []

    def broken(train, test, name, variant, *rest):
        calls.append(variant)
        if len(calls) == which + 1:
            raise ValueError("no fit")
        return plain(train, test, name, variant, *rest)

    monkeypatch.setattr(models, "run_fold", broken)
    return calls


def test_a_cross_validation_with_a_failed_fit_has_no_result(work, starts, monkeypatch):
    """All fits are tried, but the rows of the others, or none, are not taken for the whole."""
    calls = one_fit_fails(monkeypatch)
    only = {"plain": FEATURES}
    with pytest.raises(models.FitsFailed, match="1 of 3 fits failed.*no fit"):
        cross_validation.predictions(work, ["random_forest"], only, starts[:3], QUICK, in_flight=1)
    assert len(calls) == 3
    one_fit_fails(monkeypatch, which=0)
    with pytest.raises(models.FitsFailed, match="1 of 1 fits failed"):
        models.run_experiments(work.ranged, starts[:1], [("random_forest", "plain", FEATURES)], None, QUICK)


def test_a_failed_fit_with_volatility_is_raised_and_then_repeated(spark, work, starts, tmp_path, monkeypatch):
    """A resumable run ends with an error too; called again it fits what failed and gives the whole."""
    calls = one_fit_fails(monkeypatch)
    only = {"plain_garch": VARIANTS["plain_garch"]}
    args = {"boundaries": starts[:2], "overrides": QUICK, "in_flight": 1, "folder": str(tmp_path)}
    with pytest.raises(models.FitsFailed, match="1 of 2 fits failed"):
        cross_validation.predictions(work, ["random_forest"], only, **args)
    assert sorted(r.status for r in models.outcomes(spark, str(tmp_path)).collect()) == ["failed: no fit", "fitted"]
    got = cross_validation.predictions(work, ["random_forest"], only, **args)
    assert len(calls) == 3 and got.select("fold_id").distinct().count() == 2
    one_fit_fails(monkeypatch, which=0)
    alone = [("random_forest", "v", VARIANTS["plain_garch"])]
    with pytest.raises(models.FitsFailed, match="1 of 1 fits failed"):
        models.run_experiments(work.ranged, starts[:1], alone, work.garch, QUICK, folder=f"{tmp_path}/alone")


@pytest.fixture(scope="module")
def logged(spark, work, starts, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("runs"))
    predicted = cross_validation.predictions(work, ["random_forest"], VARIANTS, boundaries=starts[:3], overrides=QUICK)
    results, summary = cross_validation.evaluate(predicted)
    for _ in range(2):
        cross_validation.log_runs(
            results, summary, work.folds, VARIANTS, "t", root, ["random_forest", "catboost"], {"numTrees": 5}
        )
    return predicted, results, summary, root


def test_cross_validation_learns_the_signal(logged):
    predicted, results, summary, _ = logged
    assert predicted.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.PREDICTIONS]
    assert results.count() == 6
    for s in summary.collect():
        assert s.n_folds == 3 and s.mean_ic_pearson > 0.5 and s.meets_threshold


def test_run_log_and_reports(spark, logged):
    _, _, summary, root = logged
    runs = {(r.model_name, r.feature_variant): r for r in spark.read.schema(schemas.RUNS).parquet(f"{root}/runs").collect()}
    assert len(runs) == 4 and {r.status for r in runs.values()} == {"ok", "no_valid_folds"}
    never = runs["catboost", "plain"]
    assert never.n_folds == 0 and not never.meets_threshold and never.mean_ic_pearson is None
    fitted = runs["random_forest", "plain_garch"]
    assert fitted.params["numTrees"] == "5" and fitted.params["maxDepth"] == "4" and fitted.n_features == 4
    assert fitted.target == TARGET and fitted.n_folds_requested > 3 == fitted.n_folds
    fold_rows = spark.read.schema(schemas.FOLD_RESULTS).parquet(f"{root}/fold_results")
    assert fold_rows.count() == 6 and fold_rows.filter("test_start is null or ic_pearson is null").isEmpty()
    report = spark.read.option("header", True).csv(f"{root}/csv/cv_metrics/run_group=t")
    assert report.columns == [
        "model", "feature_variant", "mean_ic_pearson", "positive_fold_pct", "ic_t_stat", "n_folds", "meets_threshold"
    ]
    assert spark.read.option("header", True).csv(f"{root}/csv/fold_results/run_group=t").count() == 6
    best = tables.read_json(spark, f"{root}/json/best_config/run_group=t", schemas.CHALLENGER).first()
    assert best.mean_ic_pearson == summary.agg(F.max("mean_ic_pearson")).first()[0]
    assert best.feature_cols == VARIANTS[best.feature_variant]


@pytest.fixture(scope="module")
def promoted(spark, snapshot, logged, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("artifact"))
    challenger = tables.read_json(spark, f"{logged[3]}/json/best_config/run_group=t", schemas.CHALLENGER)
    challenger = challenger.withColumns({
        "feature_variant": F.lit("plain_garch"), "feature_cols": F.array(*[F.lit(c) for c in VARIANTS["plain_garch"]])
    })
    reasons = promotion.promote(
        challenger, f"{root}/registry", snapshot, f"{root}/models", required=(TARGET, *FEATURES), overrides=QUICK
    )
    assert reasons == []
    registry, _ = commits.newest(spark, f"{root}/registry", schemas.REGISTRY)
    return selection.production_artifact(registry), challenger, root


def test_promotion_writes_artifact_and_registry(spark, promoted):
    artifact, _, root = promoted
    model, meta = promotion.load_artifact(spark, artifact)
    assert meta["uses_garch"] and meta["target"] == TARGET and meta["feature_cols"] == VARIANTS["plain_garch"]
    assert meta["train_rows"] == 980 - 2 and meta["walk_forward_n_folds"] == 3
    assert meta["n_features"] == 4 and meta["params"]["numTrees"] == "5" and meta["params"]["maxDepth"] == "4"
    registry, number = commits.newest(spark, f"{root}/registry", schemas.REGISTRY)
    latest = registry.collect()
    assert number == 1 and [(r.name, r.version, r.stage) for r in latest] == [(REGISTERED_MODEL_NAME, 1, "Production")]
    assert len(model.stages) == 2


def test_a_second_group_leaves_the_first_ones_reports(spark, logged, tmp_path):
    _, results, summary, _ = logged
    folds = spark.createDataFrame([("A", i, dt.date(2020, 1, 1) + dt.timedelta(i), dt.date(2020, 1, 1)) for i in range(100)],
                                  "series_id string, fold_id int, train_end date, test_start date")
    for group in ("a", "b"):
        only = summary.filter(F.col("feature_variant") == {"a": "plain", "b": "plain_garch"}[group])
        cross_validation.log_runs(results, only, folds, VARIANTS, group, str(tmp_path), ["random_forest"])
    for group, variant in (("a", "plain"), ("b", "plain_garch")):
        of = [cross_validation.of_group(str(tmp_path), name, group) for name in ("json/best_config", "csv/cv_metrics")]
        assert tables.read_json(spark, of[0], schemas.CHALLENGER).first().feature_variant == variant
        assert [r.feature_variant for r in spark.read.option("header", True).csv(of[1]).collect()] == [variant]
    both = spark.read.json(f"{tmp_path}/json/cv_metrics")
    assert {r.run_group for r in both.collect()} == {"a", "b"}


def test_a_run_that_was_cut_off_is_repeated(spark, snapshot, promoted, tmp_path, monkeypatch):
    """Files of a snapshot without a commit are in nobody's way."""
    _, challenger, _ = promoted
    args = (challenger, f"{tmp_path}/r", snapshot, f"{tmp_path}/m", GateSettings(min_mean_ic=-1.0), (TARGET, *FEATURES), QUICK)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as cut:
        cut.setattr(commits, "put_if_absent", dies)
        with pytest.raises(OSError):
            promotion.promote(*args)
    assert commits.newest(spark, f"{tmp_path}/r", schemas.REGISTRY)[1] == 0
    assert len(list((tmp_path / "r" / "data").iterdir())) == 1
    assert promotion.promote(*args) == []
    registry, number = commits.newest(spark, f"{tmp_path}/r", schemas.REGISTRY)
    assert number == 1 and [r.version for r in registry.collect()] == [1]


@pytest.mark.parametrize("name, overrides", [
    ("random_forest", {"numTrees": 7}), ("xgboost", {"maxIter": 7}), ("lightgbm", {"maxIter": 7}), ("catboost", {"maxIter": 7}),
])
def test_both_ways_of_scoring_agree(spark, snapshot, name, overrides):
    frame = snapshot.na.drop()
    model = models.refit(frame, name, FEATURES, overrides)
    nodes = tables.materialise(tree_tables.node_table(spark, model), "nodes")
    assert nodes.select("tree").distinct().count() == 7 and nodes.filter("left = -1 and feature is not null").isEmpty()
    keys = ["series_id", "trade_date"]
    scored = scoring.score(snapshot, model, name, "v", FEATURES)
    own = tree_tables.score_by_nodes(snapshot, nodes, FEATURES, keys, model.stages[-1].getMaxDepth())
    compared = tree_tables.scoring_difference(scored, own, keys)
    assert [tuple(r) for r in compared.groupBy("difference").count().collect()] == [(0.0, 1000)]
    moved = nodes.withColumn("value", F.col("value") + F.when(F.col("tree") == 3, 0.5).otherwise(0.0))
    own = tree_tables.score_by_nodes(snapshot, moved, FEATURES, keys, 4)
    assert tree_tables.scoring_difference(scored, own, keys).filter("difference = 0").isEmpty()
    short = tree_tables.score_by_nodes(snapshot, nodes, FEATURES, keys, 0)
    assert tree_tables.scoring_difference(scored, short, keys).filter("difference = 0").isEmpty()


def test_fits_in_flight_share_a_boundarys_rows(spark, work, starts, monkeypatch):
    """Every (boundary, experiment) is fitted once, whatever the width of the queue."""
    plain, read = models.run_fold, []
    monkeypatch.setattr(models, "fold_rows", lambda *a, rows=models.fold_rows: read.append(a[1]) or rows(*a))
    experiments = [("random_forest", name, columns) for name, columns in VARIANTS.items()]
    wide, narrow = (
        models.run_experiments(work.ranged, starts[:3], experiments, work.garch, QUICK, in_flight=n) for n in (6, 1)
    )
    assert sorted(read) == sorted([*starts[:3], *starts[:3]]) and models.run_fold is plain
    assert rows(wide, "feature_variant", "trade_date") == rows(narrow, "feature_variant", "trade_date")


def test_failed_gate_writes_nothing(spark, snapshot, promoted, tmp_path):
    _, challenger, _ = promoted
    reasons = promotion.promote(
        challenger, f"{tmp_path}/r", snapshot, f"{tmp_path}/m",
        GateSettings(min_mean_ic=2.0), (TARGET, *FEATURES), QUICK,
    )
    assert reasons == ["mean_ic_pearson below floor"] and list(tmp_path.iterdir()) == []


def test_no_challenger_is_a_reason(spark, snapshot, tmp_path):
    none = spark.createDataFrame([], schemas.CHALLENGER)
    assert promotion.promote(none, f"{tmp_path}/r", snapshot, f"{tmp_path}/m") == ["no challenger"]
    assert list(tmp_path.iterdir()) == []


def test_missing_features_are_named_in_order(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 1.0, 2.0)], "id int, b double, a double")
    valid, rejected = scoring.split_valid(df, ["b", "a"])
    assert [r.id for r in valid.collect()] == [2]
    assert [(r.id, r.missing) for r in rejected.collect()] == [(1, ["a"])]
    absent = scoring.with_missing(df, ["c", "b", "a"]).orderBy("id").collect()
    assert [r.missing for r in absent] == [["c", "a"], ["c"]]
    odd = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, float("nan"), float("inf"), None])], "id int, a double")
    assert [r.missing for r in scoring.with_missing(odd, ["a"]).orderBy("id").collect()] == [[], ["a"], ["a"], ["a"]]


def test_supplied_volatility_is_overwritten(spark):
    df = spark.createDataFrame([("A", 9.0, 9.0)], "series_id string, garch_sigma double, garch_sigma_chg double")
    state = spark.createDataFrame([("A", 0.1, 0.01)], df.schema)
    assert rows(scoring.fill_garch(df, state)) == [("A", 0.1, 0.01)]


def test_stream_scores_like_batch_and_rejects_incomplete_rows(spark, snapshot, promoted, tmp_path):
    model, meta = promotion.load_artifact(spark, promoted[0])
    state = tables.materialise(promotion.serving_state(snapshot), "test-state")
    day = F.dayofmonth("trade_date")
    requests = snapshot.withColumn("x2", F.when(day == 14, float("nan")).when(day != 13, F.col("x2")))
    inbox = f"{tmp_path}/inbox"
    requests.repartition(5).write.parquet(inbox)
    args = (model, meta["model_name"], meta["feature_variant"], meta["feature_cols"])
    expected = rows(scoring.score(requests, *args, state), "trade_date")
    assert 0 < len(expected) < 1000 and expected[0][3:] == (TARGET, "random_forest", "plain_garch")

    def drain():
        rows_in = read_stream(spark, inbox, requests.schema, files_per_batch=2)
        for q in score_stream(rows_in, *args, f"{tmp_path}/scored", f"{tmp_path}/rejected", f"{tmp_path}/ck", state):
            q.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/scored"), spark.read.parquet(f"{tmp_path}/rejected")

    scored, rejected = drain()
    assert rows(scored, "trade_date") == expected
    assert rejected.count() == 1000 - len(expected) and rejected.first().missing == ["x2"]
    scored, _ = drain()
    assert scored.count() == len(expected)


def test_state_comes_from_the_newest_row_even_without_target(spark, snapshot):
    last = snapshot.agg(F.max("trade_date")).first()[0]
    path = promotion.garch_final(snapshot)
    newest = path.filter(F.col("trade_date") == last).first()
    assert rows(promotion.serving_state(snapshot)) == [("A", newest.garch_sigma, newest.garch_sigma_chg)]
    assert isinstance(last, dt.date)


def test_sampled_row_is_complete_and_repeatable(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1.0) for i in range(40)], "id int, a double")
    first, again = (
        scoring.sample_complete_row(df.repartition(n), ["a"], seed=5, keys=("id",)).collect() for n in (1, 7)
    )
    assert len(first) == 1 and first == again and first[0].a == 1.0
