"""The batch stages as jobs: extract, train, promote, score.

    python -m tidewalk.jobs extract --market <dir> --features <dir> --boundaries <dir>
    python -m tidewalk.jobs train   --features <dir> --boundaries <dir> --runs <dir> --group <name>
    python -m tidewalk.jobs promote --features <dir> --runs <dir> --group <name> --registry <dir> --models <dir>
    python -m tidewalk.jobs score   --features <dir> --registry <dir> --rows <dir> --out <dir>

On a cluster submit this file with the package: spark-submit --py-files tidewalk.zip tidewalk/jobs.py <stage> ...
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from tidewalk import schemas
from tidewalk.config import BASE_FEATURES, FEATURE_VARIANTS, MODELS, TARGET, GateSettings, MarketNames
from tidewalk.operators import scoring, selection
from tidewalk.operators.folds import monthly_boundaries
from tidewalk.plans import cross_validation, promotion
from tidewalk.plans.daily_features import daily_features
from tidewalk.session import SETTINGS
from tidewalk.sources import commits, tables

REQUIRED = (TARGET, *BASE_FEATURES)


def extract(spark: SparkSession, market: str, features: str, boundaries: str, series_id: str | None = None) -> None:
    """Market tables -> feature snapshot and monthly boundaries."""
    names = MarketNames()
    sources = tables.read_market_tables(spark, market, series_id)
    tables.write_snapshot(daily_features(sources, names), features)
    written = tables.read_snapshot(spark, features)
    monthly_boundaries(sources["instruments"], written, names.ticker).write.mode("overwrite").parquet(boundaries)


def train(
    spark: SparkSession, features: str, boundaries: str, runs: str, group: str, required: Sequence[str] = REQUIRED,
    model_names: Sequence[str] = tuple(MODELS), variants: Mapping[str, Sequence[str]] = FEATURE_VARIANTS,
    overrides: dict | None = None, in_flight: int | None = None,
) -> None:
    """Snapshot -> cross-validated experiments, their log and reports, and the winning configuration.

    Fits are kept below `runs`/fits, so a group that was cut off goes on where it stopped.
    """
    work = cross_validation.prepare(
        tables.read_snapshot(spark, features), tables.read_boundaries(spark, boundaries), required
    )
    predicted = cross_validation.predictions(
        work, model_names, variants, overrides=overrides, in_flight=in_flight, folder=f"{runs}/fits/{group}"
    )
    if predicted is None:
        raise RuntimeError("no experiment produced a valid fold")
    results, summary = cross_validation.evaluate(predicted, GateSettings.from_env())
    cross_validation.log_runs(
        results, tables.materialise(summary, "summary"), work.folds, variants, group, runs, model_names, overrides
    )


def promote(
    spark: SparkSession, features: str, runs: str, group: str, registry: str, models: str,
    required: Sequence[str] = REQUIRED, overrides: dict | None = None,
) -> list[str]:
    """A group's winning configuration -> gate -> refit, artifact and a new registry snapshot; returns the reasons
    against."""
    challenger = tables.read_json(spark, cross_validation.of_group(runs, "json/best_config", group), schemas.CHALLENGER)
    return promotion.promote(
        challenger, registry, tables.read_snapshot(spark, features), models, GateSettings.from_env(), required, overrides
    )


def score(spark: SparkSession, features: str, registry: str, rows: str, out: str) -> None:
    """Score feature rows with the Production model; rejected rows and their missing names go beside the scores."""
    current, _ = commits.newest(spark, registry, schemas.REGISTRY)
    artifact = selection.production_artifact(current)
    if artifact is None:
        raise RuntimeError("no Production model")
    model, meta = promotion.load_artifact(spark, artifact)
    state = None
    if meta["uses_garch"]:
        state = tables.materialise(promotion.serving_state(tables.read_snapshot(spark, features)), "garch-state")
    requests = tables.read_snapshot(spark, rows)
    filled = requests if state is None else scoring.fill_garch(requests, state)
    _, rejected = scoring.split_valid(filled, meta["feature_cols"])
    scored = scoring.score(requests, model, meta["model_name"], meta["feature_variant"], meta["feature_cols"], state)
    scored.write.mode("overwrite").parquet(f"{out}/scored")
    rejected.select("series_id", "trade_date", "missing").write.mode("overwrite").parquet(f"{out}/rejected")


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidewalk.jobs")
    stages = parser.add_subparsers(dest="stage", required=True)
    needed = {
        "extract": ("market", "features", "boundaries"),
        "train": ("features", "boundaries", "runs", "group"),
        "promote": ("features", "runs", "group", "registry", "models"),
        "score": ("features", "registry", "rows", "out"),
    }
    for stage, names in needed.items():
        one = stages.add_parser(stage)
        for name in names:
            one.add_argument(f"--{name}", required=True)
    stages.choices["extract"].add_argument("--series-id", dest="series_id")
    stages.choices["train"].add_argument("--in-flight", dest="in_flight", type=int)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    arguments = vars(_arguments(argv))
    stage = {"extract": extract, "train": train, "promote": promote, "score": score}[arguments.pop("stage")]
    builder = SparkSession.builder.appName(f"tidewalk-{stage.__name__}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    reasons = stage(builder.getOrCreate(), **arguments)
    for reason in reasons or ():
        print(f"not promoted: {reason}", file=sys.stderr)
    return 1 if reasons else 0


if __name__ == "__main__":
    sys.exit(main())
