"""Arrow-batched Python over DataFrames, and shipping this library's code to where it runs."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROWS_PER_BATCH = 256
BYTES_PER_BATCH = 16 << 20
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the library's code to the executors, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="spanloom-code-")) / "spanloom_lib.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def _release() -> None:
    """Hands memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def by_batches(frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow in batches of at most ROWS_PER_BATCH rows and, but for a single longer row, about BYTES_PER_BATCH bytes.

    So long texts fit a worker's memory. Both limits are settings of the session.
    Workers wait for further tasks when one is done, beside those of the next
    step, so they hand back what they no longer use.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            _release()

    ship(frame.sparkSession)
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    return frame.mapInArrow(tidy, schema)
