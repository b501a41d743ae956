import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewalk.config import REGISTERED_MODEL_NAME, GateSettings
from tidewalk.operators import selection
from tidewalk.schemas import CHALLENGER, REGISTRY

GATE = GateSettings()


def challenger(spark, **changes):
    row = {
        "run_id": "r1", "model_name": "m", "feature_variant": "v", "feature_cols": ["a"],
        "mean_ic_pearson": GATE.min_mean_ic + 0.02, "positive_fold_pct": GATE.min_positive_share + 0.05,
        "meets_threshold": True, "n_folds": 80, **changes,
    }
    return spark.createDataFrame([tuple(row[c] for c in CHALLENGER.fieldNames())], CHALLENGER)


def registry(spark, *versions):
    data = [(REGISTERED_MODEL_NAME, v, stage, {"mean_ic_pearson": ic} if ic else {}) for v, stage, ic in versions]
    return spark.createDataFrame(data, REGISTRY)


def verdict(spark, production=(), gate=GATE, **changes):
    current = selection.current_production(registry(spark, *production))
    return selection.promotion_gate(challenger(spark, **changes), current, gate).first()


def test_passes_without_production(spark):
    got = verdict(spark)
    assert got.passed and got.reasons == []


def test_zero_folds_fail(spark):
    got = verdict(spark, n_folds=0)
    assert not got.passed and got.reasons == ["no completed folds"]


def test_low_ic_and_low_share_are_both_reported(spark):
    got = verdict(spark, mean_ic_pearson=GATE.min_mean_ic - 0.01, positive_fold_pct=GATE.min_positive_share - 0.01)
    assert got.reasons == ["mean_ic_pearson below floor", "positive_fold_pct below floor"]


def test_worse_than_production_fails_and_better_passes(spark):
    assert verdict(spark, [(1, "Production", "0.2")]).reasons == ["mean_ic_pearson below production"]
    assert verdict(spark, [(1, "Production", "0.05")]).passed
    assert verdict(spark, [(1, "Production", "0.08")], GateSettings(regression_tolerance=0.02)).passed


def test_missing_statistics_fail(spark):
    got = verdict(spark, [(1, "Production", "0.01")], mean_ic_pearson=None, positive_fold_pct=None, n_folds=None)
    assert got.reasons == ["no completed folds", "mean_ic_pearson below floor", "positive_fold_pct below floor"]


def test_threshold_flag_is_not_consulted(spark):
    assert verdict(spark, meets_threshold=False).passed


def test_lookup_takes_the_latest_production_version(spark):
    current = selection.current_production(
        registry(spark, (1, "Production", "0.1"), (2, "Production", "0.3"), (3, "Archived", "0.9"))
    )
    assert rows(current) == [(REGISTERED_MODEL_NAME, 2, 0.3)]
    assert selection.current_production(registry(spark, (3, "Archived", "0.9"))).isEmpty()


@pytest.mark.parametrize("tag", [None, "not a number"])
def test_production_without_a_usable_tag_does_not_block(spark, tag):
    assert verdict(spark, [(1, "Production", tag)]).passed


def test_publish_archives_and_numbers(spark):
    before = registry(spark, (1, "Archived", "0.1"), (2, "Production", "0.2")).union(
        spark.createDataFrame([("other", 7, "Production", {})], REGISTRY)
    )
    after = selection.publish(before, challenger(spark))
    got = {(r.name, r.version): r.stage for r in after.collect()}
    assert got == {
        (REGISTERED_MODEL_NAME, 1): "Archived", (REGISTERED_MODEL_NAME, 2): "Archived",
        (REGISTERED_MODEL_NAME, 3): "Production", ("other", 7): "Production",
    }
    tags = after.filter("version = 3").first().tags
    assert tags["source_run_id"] == "r1" and float(tags["mean_ic_pearson"]) == pytest.approx(0.07)
    first = selection.publish(registry(spark).limit(0), challenger(spark))
    assert [(r.version, r.stage) for r in first.collect()] == [(1, "Production")]


def summaries(spark, *entries):
    df = spark.createDataFrame(
        entries, "model_name string, feature_variant string, mean_ic_pearson double, positive_fold_pct double"
    )
    return selection.with_threshold_flag(df.withColumns({"ic_t_stat": F.lit(1.0), "n_folds": F.lit(3)}))


def test_rank_is_by_ic_then_name_with_missing_last(spark):
    df = summaries(spark, ("b", "v", 0.1, 0.9), ("a", "v", 0.1, 0.9), ("c", "v", None, 0.9), ("d", "v", 0.3, 0.1))
    assert [r.model for r in selection.report(df).collect()] == ["d", "a", "b", "c"]


def test_winner_is_the_best_eligible_else_the_best(spark):
    df = summaries(spark, ("a", "v", 0.1, 0.9), ("d", "v", 0.3, 0.1))
    assert selection.pick_winner(df).first().model_name == "a"
    assert selection.pick_winner(df.filter("model_name = 'd'")).first().model_name == "d"
    none = summaries(spark, ("x", "v", None, 0.0), ("y", "v", 0.01, 0.0))
    winner = selection.pick_winner(none).first()
    assert winner.model_name == "y" and winner.meets_threshold is False


def test_gate_reads_the_environment(monkeypatch):
    monkeypatch.setenv("PROMOTION_MIN_MEAN_IC", "0.2")
    assert GateSettings.from_env() == GateSettings(min_mean_ic=0.2)
