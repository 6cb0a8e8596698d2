"""What the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.arrow import by_batches, ship  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % divisor


def fresh_name(frame: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {name.lower() for name in frame.columns}
    while base.lower() in taken:
        base += "_"
    return base


def checkpoint_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; where it is unset, a temporary folder if all runs on this machine, else an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="spanloom-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared checkpoint folder; it is deleted when the application ends."""
    folder = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path, store = _path(spark, folder)
    store.mkdirs(path)
    store.deleteOnExit(path)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    path, store = _path(spark, folder)
    store.delete(path, True)


def cut(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared checkpoint folder and read from there."""
    checkpoint_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def sha256_of(parts: Column) -> Column:
    """Lower-case hex SHA-256 of an array of strings, comma-joined."""
    return F.sha2(F.array_join(parts, ","), 256)


def tokenizer_file(name: str, folder: str | None = None) -> str:
    return os.path.join(folder or os.environ.get("SPANLOOM_TOKENIZERS", "/opt/tokenizers"), name)
