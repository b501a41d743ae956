"""Scoring a stream of feature rows. Stateless: every row is judged on its own, so there is no watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewalk.operators import scoring


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_stream(
    rows: DataFrame, model: PipelineModel, model_name: str, variant: str, feature_cols: Sequence[str],
    scored_path: str, rejected_path: str, checkpoint: str, garch_state: DataFrame | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Drain what is available: scored rows to one Parquet sink, rejected rows with their missing names to another.

    Each sink has its own checkpoint, so a restart continues where its query stopped and files commit once.
    """
    scored = scoring.score(rows, model, model_name, variant, feature_cols, garch_state)
    filled = rows if garch_state is None else scoring.fill_garch(rows, garch_state)
    _, rejected = scoring.split_valid(filled, feature_cols)
    return (
        _drain(scored, scored_path, f"{checkpoint}/scored"),
        _drain(rejected.select("series_id", "trade_date", "missing"), rejected_path, f"{checkpoint}/rejected"),
    )


def _drain(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        frame.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    )
