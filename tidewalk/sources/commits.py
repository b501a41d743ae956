"""Numbered snapshots that become visible as a whole, by a commit written last.

A snapshot's files go to a folder of their own, drawn by its writer; nobody reads them until `commits/<number>.json`
names that folder. A commit appears at once and only if its number is free, so of two writers of one number one fails,
and what a writer left behind without a commit is never read and in nobody's way.

    root/data/<uuid>/part-...     the files of a snapshot, committed or not
    root/commits/7.json           {"snapshot": 7, "folder": "<uuid>"}
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT = "snapshot int, folder string"


class NumberTaken(RuntimeError):
    """Another writer has committed this number."""


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file as a whole; False, and no change, if it exists.

    The text is written beside it and renamed without overwriting, which a file system does in one step. On an object
    store that cannot, publish from one job at a time.
    """
    jvm, configuration = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    beside = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}.tmp")
    files = target.getFileSystem(configuration)
    files.mkdirs(target.getParent())
    stream = files.create(beside, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    keep[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), configuration).rename(beside, target, keep)
    except Py4JJavaError as cause:
        files.delete(beside, False)
        if "FileAlreadyExistsException" not in str(cause.java_exception):
            raise
        return False
    return True


def commits(spark: SparkSession, root: str) -> DataFrame:
    """(snapshot, folder) of every committed snapshot."""
    try:
        return spark.read.schema(COMMIT).json(f"{root}/commits")
    except AnalysisException as cause:
        if cause.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def newest(spark: SparkSession, root: str, schema: StructType) -> tuple[DataFrame, int]:
    """The newest committed snapshot and its number; an empty table and 0 before the first."""
    last = commits(spark, root).orderBy(F.desc("snapshot")).first()
    if last is None:
        return spark.createDataFrame([], schema), 0
    return spark.read.schema(schema).parquet(f"{root}/data/{last.folder}"), last.snapshot


def commit(frame: DataFrame, root: str, number: int) -> None:
    """Write the frame as snapshot `number`; `NumberTaken`, with nothing changed for readers, if there is one already."""
    spark, folder = frame.sparkSession, uuid.uuid4().hex
    frame.write.parquet(f"{root}/data/{folder}")
    if not put_if_absent(spark, f"{root}/commits/{number}.json", json.dumps({"snapshot": number, "folder": folder}) + "\n"):
        raise NumberTaken(f"{root}: snapshot {number} exists")
