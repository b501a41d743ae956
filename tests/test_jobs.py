"""The four stages end to end over Parquet directories."""

import pytest

from tidewalk import jobs, schemas
from tidewalk.config import BASE_FEATURES, GARCH_FEATURES, TARGET
from tidewalk.sources import commits
from tidewalk.sources.proxies import market_tables

REQUIRED = jobs.REQUIRED
VARIANTS = {"few": BASE_FEATURES[:4], "few_garch": [*BASE_FEATURES[:4], *GARCH_FEATURES]}
QUICK = {"numTrees": 3}


@pytest.fixture(scope="module")
def places(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    for name, df in market_tables(spark, sf_dir.replace("0.001", "0.01")).items():
        df.drop("series_id").write.parquet(f"{root}/market/{name}")
    return {name: f"{root}/{name}" for name in ("market", "features", "boundaries", "runs", "registry", "models", "out")}


def pick(places, *names):
    return {name: places[name] for name in names}


def test_stages(spark, places, monkeypatch):
    jobs.extract(spark, **pick(places, "market", "features", "boundaries"), series_id="NIFTY")
    assert spark.read.parquet(places["features"]).columns == schemas.SNAPSHOT.fieldNames()

    assert spark.read.parquet(places["boundaries"]).count() > 70
    jobs.train(
        spark, **pick(places, "features", "boundaries", "runs"), group="g", required=REQUIRED,
        model_names=["random_forest"], variants=VARIANTS, overrides=QUICK,
    )
    runs = spark.read.schema(schemas.RUNS).parquet(f"{places['runs']}/runs").collect()
    assert {r.feature_variant for r in runs} == set(VARIANTS) and all(r.n_folds > 40 for r in runs)

    args = {**pick(places, "features", "runs", "registry", "models"), "group": "g"}
    monkeypatch.setenv("PROMOTION_MIN_MEAN_IC", "2")
    assert "mean_ic_pearson below floor" in jobs.promote(spark, **args, required=REQUIRED, overrides=QUICK)
    assert commits.newest(spark, places["registry"], schemas.REGISTRY)[1] == 0
    with pytest.raises(RuntimeError, match="no Production model"):
        jobs.score(spark, **pick(places, "features", "registry", "out"), rows=places["features"])

    monkeypatch.setenv("PROMOTION_MIN_MEAN_IC", "-2")
    monkeypatch.setenv("PROMOTION_MIN_POSITIVE_FOLD_PCT", "0")
    for expected in (1, 2):
        assert jobs.promote(spark, **args, required=REQUIRED, overrides=QUICK) == []
        registry, number = commits.newest(spark, places["registry"], schemas.REGISTRY)
        stages = {r.version: r.stage for r in registry.collect()}
        assert number == expected and stages[expected] == "Production" and len(stages) == expected
    assert stages[1] == "Archived"

    jobs.score(spark, **pick(places, "features", "registry", "out"), rows=places["features"])
    scored = spark.read.parquet(f"{places['out']}/scored")
    rejected = spark.read.parquet(f"{places['out']}/rejected")
    assert scored.count() + rejected.count() == spark.read.parquet(places["features"]).count()
    assert scored.count() > 0 and rejected.filter("size(missing) = 0").isEmpty()


def test_arguments_are_required():
    with pytest.raises(SystemExit):
        jobs._arguments(["train", "--features", "x"])
    got = jobs._arguments(["extract", "--market", "m", "--features", "f", "--boundaries", "b", "--series-id", "S"])
    assert (got.stage, got.market, got.series_id) == ("extract", "m", "S")
