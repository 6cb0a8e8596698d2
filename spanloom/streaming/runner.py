"""One streaming query for each lens.

Progress is kept by Structured Streaming's checkpoint, so there is no tie to
lose at a batch's edge. A batch's rows and their one-minute states go to a
partition that carries its number and are overwritten if the batch is replayed,
so a failure between the two writes duplicates nothing. Toggles and prices are
read again at every batch, at most once in their time to live.
"""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from spanloom.functions import sides
from spanloom.operators import registry as operators_registry
from spanloom.operators import rollup
from spanloom.plans import compiler
from spanloom.plans import specs as declared


class Refreshed:
    """A table that is loaded again once it is older than its time to live; an old one serves while loading fails.

    What is loaded is stored (keep) before it replaces the old one, so a source
    that fails when it is read leaves the old table whole.
    """

    def __init__(self, load: Callable[[], DataFrame], seconds: float = 300.0, clock: Callable[[], float] = time.monotonic, keep: Callable[[DataFrame], DataFrame] = sides.stored) -> None:
        self.load, self.seconds, self.clock, self.keep = load, seconds, clock, keep
        self.value: DataFrame | None = None
        self.loaded = 0.0

    def get(self) -> DataFrame:
        if self.value is None or self.clock() - self.loaded >= self.seconds:
            try:
                self.value, self.loaded = self.keep(self.load()), self.clock()
            except Exception:
                if self.value is None:
                    raise
        return self.value


@dataclass
class Lens:
    """context builds a lens's columns from its spans; active gives the toggles' keys (None: all on)."""

    name: str
    context: Callable[[DataFrame], DataFrame]
    active: Refreshed | None = None
    specs: Sequence[declared.MetricSpec] | None = None

    def rows(self, spans: DataFrame) -> DataFrame:
        specs = self.specs if self.specs is not None else declared.of_lens(self.name)
        return compiler.emit(self.context(compiler.spans_of_lens(spans, self.name)), specs, self.active.get() if self.active else None)


def cost_lens(prices: Refreshed, active: Refreshed | None = None) -> Lens:
    """The cost lens, with prices read again as they age."""
    return Lens("cost", lambda spans: compiler.with_cost(spans, prices.get()), active)


def write_batch(rows: DataFrame, folder: str, lens: str, batch: int) -> None:
    """Derived rows and their states, under lens and batch; writing a batch again replaces it."""
    place = f"lens={lens}/batch={batch:012d}"
    rows.write.mode("overwrite").parquet(f"{folder}/derived/{place}")
    kept = rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/derived/{place}")
    rollup.base(kept).write.mode("overwrite").parquet(f"{folder}/states/{place}")


def start(spans: DataFrame, lens: Lens, folder: str, once: bool = False, every: str = "2 seconds") -> StreamingQuery:
    """Runs a lens over a stream of spans; once: over what is there now."""
    writer = spans.writeStream.queryName(f"lens_{lens.name}").option("checkpointLocation", f"{folder}/checkpoints/{lens.name}")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.foreachBatch(lambda frame, batch: write_batch(lens.rows(frame), folder, lens.name, batch)).start()


def run_all(spans: Callable[[], DataFrame], lenses: Sequence[Lens], folder: str, once: bool = True) -> list[StreamingQuery]:
    """One query for each lens, in the same session."""
    queries = [start(spans(), lens, folder, once) for lens in lenses]
    if once:
        for query in queries:
            query.awaitTermination()
    return queries


REGISTRY = ("entities", "bindings", "observations", "thresholds")


def _versions(spark: SparkSession, folder: str):
    """The registry's folder, its file system, and its versions that are complete."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/registry")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place)
    names = [status.getPath().getName() for status in store.listStatus(place)]
    return place, store, sorted(int(name[len("complete=") :]) for name in names if name.startswith("complete="))


def registry_tables(spark: SparkSession, folder: str, before: int | None = None) -> dict[str, DataFrame] | None:
    """The registry's newest complete version (of a batch before this one); None if there is none yet."""
    known = [version for version in _versions(spark, folder)[2] if before is None or version < before]
    if not known:
        return None
    return {name: spark.read.parquet(f"{folder}/registry/version={known[-1]:012d}/{name}") for name in REGISTRY}


def reconcile_batch(spans: DataFrame, catalog: DataFrame, folder: str, batch: int) -> None:
    """The registry after a batch, as a version of its own, from the version before it: replaying a batch replaces its version.

    The last three versions are kept, for readers that are still at an older one.
    """
    spark = spans.sparkSession
    place, store, _ = _versions(spark, folder)
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(place, name)
    store.delete(path(f"complete={batch:012d}"), True)
    held = spans.persist()
    try:
        for name, table in operators_registry.reconcile(held, catalog, registry_tables(spark, folder, batch)).items():
            table.write.mode("overwrite").parquet(f"{folder}/registry/version={batch:012d}/{name}")
    finally:
        held.unpersist()
    store.mkdirs(path(f"complete={batch:012d}"))
    for old in [version for version in _versions(spark, folder)[2] if version <= batch][:-3]:
        store.delete(path(f"complete={old:012d}"), True)
        store.delete(path(f"version={old:012d}"), True)


def start_reconciler(spans: DataFrame, catalog: DataFrame, folder: str, once: bool = False, every: str = "2 seconds") -> StreamingQuery:
    """Keeps the registry of entities, bindings, observations and thresholds up to date with a stream of spans.

    A new query begins with all spans that are there, which is the backfill.
    """
    writer = spans.writeStream.queryName("reconciler").option("checkpointLocation", f"{folder}/checkpoints/reconciler")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.foreachBatch(lambda frame, batch: reconcile_batch(frame, catalog, folder, batch)).start()


def stop_all(queries: Sequence[StreamingQuery], seconds: float = 0.0) -> None:
    """Stops the queries; batches under way get this time to end. What is cut off is replayed at the next start."""
    ends = time.monotonic() + seconds
    while time.monotonic() < ends and any(query.isActive and query.status["isTriggerActive"] for query in queries):
        time.sleep(0.05)
    for query in queries:
        query.stop()


def serve(queries: Sequence[StreamingQuery], seconds: float = 30.0, signals: Sequence[int] = (signal.SIGTERM, signal.SIGINT)) -> None:
    """Waits until a signal comes or a query ends, then stops all, with that time to drain. Call it in the main thread."""
    asked = threading.Event()
    before = {number: signal.signal(number, lambda *_: asked.set()) for number in signals}
    try:
        while not asked.wait(0.2) and all(query.isActive for query in queries):
            pass
    finally:
        stop_all(queries, seconds)
        for number, handler in before.items():
            signal.signal(number, handler)


def derived(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/derived")


def states(spark: SparkSession, folder: str) -> DataFrame:
    """All states; readers merge them."""
    return spark.read.parquet(f"{folder}/states")


class Progress(StreamingQueryListener):
    """Counts batches and rows of every query, and its failures."""

    def __init__(self) -> None:
        self.batches: dict[str, int] = {}
        self.rows: dict[str, int] = {}
        self.failures: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.batches.setdefault(event.name or str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        name = event.progress.name or str(event.progress.id)
        self.batches[name] = self.batches.get(name, 0) + 1
        self.rows[name] = self.rows.get(name, 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures[str(event.id)] = event.exception
