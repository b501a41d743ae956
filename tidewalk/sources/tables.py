"""Reading market tables and snapshots, writing snapshots and reports."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewalk import schemas


def read_market_tables(spark: SparkSession, root: str, series_id: str | None = None) -> dict[str, DataFrame]:
    """The nine source tables as Parquet directories under `root`.

    Give `series_id` when the files hold one market and carry no series column.
    """
    tables = {}
    for name, schema in schemas.SOURCE_TABLES.items():
        if series_id is not None:
            schema = StructType([field for field in schema if field.name != "series_id"])
        frame = spark.read.schema(schema).parquet(f"{root}/{name}")
        tables[name] = frame if series_id is None else frame.withColumn("series_id", F.lit(series_id))
    return tables


def read_market_tables_jdbc(
    spark: SparkSession, url: str, first_day: str, last_day: str, partitions: int, schema: str = "nse",
    properties: dict | None = None, fetch_rows: int = 10_000,
) -> dict[str, DataFrame]:
    """The same tables from a database, read in parallel date slices (the bounds slice, they do not filter) with the
    declared types. Instruments are sliced by expiry; rows with a null day are in the first slice."""
    tables = {}
    for name, declared in schemas.SOURCE_TABLES.items():
        typed = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in declared)
        options = {
            "url": url, "dbtable": f"{schema}.{name}", "customSchema": typed, "fetchsize": str(fetch_rows),
            "partitionColumn": "trade_date" if "trade_date" in declared.fieldNames() else "expiry",
            "lowerBound": first_day, "upperBound": last_day, "numPartitions": str(partitions), **(properties or {}),
        }
        tables[name] = spark.read.format("jdbc").options(**options).load()
    return tables


def write_snapshot(frame: DataFrame, path: str) -> None:
    """Write features sorted by key inside each file, so date and series filters skip row groups.

    The frame already arrives hashed by series, so no exchange is added, and there is no directory per series:
    with very many series that would mean as many tiny files.
    """
    frame.sortWithinPartitions("series_id", "trade_date").write.mode("overwrite").parquet(path)


def write_ordered(frame: DataFrame, path: str, keys: Sequence[str] = ("trade_date", "series_id")) -> None:
    """Write rows in key order across files and inside them: a file's keys all come before the next file's.

    One exchange by key range, whose bounds are sampled; use it where readers go through the files in order.
    """
    frame.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def in_file_order(frame: DataFrame) -> DataFrame:
    """Rows of a file source with `place`, from 1: files by name, rows as they lie in them.

    Only the files' row counts are gathered to number the rows; the rows themselves are not moved by key.
    """
    named = frame.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = named.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    by_name = Window.orderBy(F.length("_file"), "_file")  # numbers of more than five digits make names longer
    before = F.coalesce(F.sum("_n").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_file", before.alias("_before"))
    return named.join(starts, "_file").select(*frame.columns, (F.col("_before") + F.col("_row") + 1).alias("place"))


def read_snapshot(spark: SparkSession, path: str, schema: StructType = schemas.SNAPSHOT) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BOUNDARIES).parquet(path)


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)


def write_json(frame: DataFrame, path: str) -> None:
    """NULL fields are written out, so a missing statistic reads back as missing, not as an absent key."""
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append(frame: DataFrame, path: str) -> None:
    frame.write.mode("append").parquet(path)


def working_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a fresh local one only on a local master."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root is None and spark.sparkContext.getCheckpointDir():
        root = spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidewalk-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def new_working_path(spark: SparkSession, label: str) -> str:
    return f"{working_root(spark)}/tidewalk/{label}-{uuid.uuid4().hex}"


def materialise(frame: DataFrame, label: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame that several jobs will read, and read it back.

    Lineage is cut at a file in shared storage, so a lost executor costs a re-read and not a recomputation, and
    later jobs still get column pruning and filter pushdown. `sort_by` orders rows inside each file, without a
    shuffle, so filters on those columns skip row groups.
    """
    path = new_working_path(frame.sparkSession, label)
    ordered = frame.sortWithinPartitions(*sort_by) if sort_by else frame
    ordered.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
