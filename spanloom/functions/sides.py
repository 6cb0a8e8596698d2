"""Small sides of joins: stored once, broadcast only when a count allows it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sides are broadcast up to this many rows (of a hundred bytes each).
MAX_BROADCAST_ROWS = 200_000


def stored(frame: DataFrame) -> DataFrame:
    """The frame as it is now, written to the shared checkpoint folder: what reads it later repeats no work and can't fail on its source."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="spanloom-checkpoint-")
        context.setCheckpointDir(folder)
    return frame.checkpoint(eager=True)


def small(side: DataFrame) -> DataFrame:
    """A broadcast of the side if a count shows that it is small; store a side first if it takes work to compute."""
    return F.broadcast(side) if side.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else side
