"""Streams of spans: exactly one row whatever is replayed."""

import os
import shutil
import signal
import threading

from pyspark.sql import functions as F

from spanloom.operators import registry, rollup
from spanloom.plans import compiler
from spanloom.plans import specs as declared
from spanloom.sources import fixtures, tables
from spanloom.streaming import runner


def test_available_now_matches_the_batch(spark, sf, tmp_path):
    source, out = str(tmp_path / "spans"), str(tmp_path / "out")
    spans = fixtures.spans_from_events(spark, sf)
    half = F.xxhash64("span_id") % 2 == 0
    lenses = [runner.Lens("performance", compiler.with_performance), runner.Lens("cost", lambda s: compiler.with_cost(s, tables.StaticPricing(fixtures.PRICES).load(spark)))]
    listener = runner.Progress()
    spark.streams.addListener(listener)
    for part in (spans.where(half), spans.where(~half)):
        part.coalesce(1).write.mode("append").parquet(source)
        runner.run_all(lambda: tables.span_stream(spark, source), lenses, out)
    runner.run_all(lambda: tables.span_stream(spark, source), lenses, out)  # nothing new
    spark.streams.removeListener(listener)
    expected = compiler.emit(compiler.with_performance(spans), runner.declared.of_lens("performance"))
    got = runner.derived(spark, out).where("lens = 'performance'")
    assert got.count() == expected.count()
    read = lambda states: sorted((r.metric, r["count"], round(r.sum_value, 3)) for r in rollup.read(states, ["metric"], ()).collect())
    assert read(runner.states(spark, out).where("lens = 'performance'")) == read(rollup.base(expected))
    before = runner.derived(spark, out).count()
    runner.write_batch(lenses[0].rows(spans.where(half)), out, "performance", 0)  # a replayed batch
    assert runner.derived(spark, out).count() == before
    assert not listener.failures


def test_refreshed_keeps_what_it_has():
    now = [0.0]
    answers = iter([1, ValueError("down"), 2])

    def load():
        value = next(answers)
        if isinstance(value, Exception):
            raise value
        return value

    table = runner.Refreshed(load, 10, lambda: now[0], keep=lambda value: value)
    assert table.get() == 1 and table.get() == 1
    now[0] = 11
    assert table.get() == 1 and table.get() == 2


def test_refreshed_survives_a_source_that_fails_when_it_is_read(spark, tmp_path):
    place, now = str(tmp_path / "toggles"), [0.0]
    spark.range(3).write.parquet(place)
    frame = spark.read.parquet(place)  # lazy: nothing fails until it is read
    table = runner.Refreshed(lambda: frame, 10, lambda: now[0])
    assert table.get().count() == 3
    shutil.rmtree(place)
    now[0] = 11
    assert table.get().count() == 3


def _content(tables):
    return {name: sorted(map(str, table.collect())) for name, table in tables.items()}


def test_reconciler_stream_is_the_batch_and_survives_a_replay(spark, sf, tmp_path):
    source, out = str(tmp_path / "spans"), str(tmp_path / "out")
    spans, catalog = fixtures.spans_from_events(spark, sf), declared.catalog(spark)
    half = F.xxhash64("span_id") % 2 == 0
    for part in (spans.where(half), spans.where(~half)):
        part.coalesce(1).write.mode("append").parquet(source)
        runner.start_reconciler(tables.span_stream(spark, source), catalog, out, once=True).awaitTermination()
    expected = _content(registry.reconcile(spans, catalog, registry.reconcile(spans.where("false"), catalog)))
    assert _content(runner.registry_tables(spark, out)) == expected
    runner.reconcile_batch(spans.where(~half), catalog, out, 1)  # the last batch again
    assert _content(runner.registry_tables(spark, out)) == expected


def test_serve_drains_on_a_signal(spark, sf, tmp_path):
    source, out = str(tmp_path / "spans"), str(tmp_path / "out")
    spans = fixtures.spans_from_events(spark, sf).limit(200)
    spans.coalesce(1).write.parquet(source)
    query = runner.start(tables.span_stream(spark, source), runner.Lens("performance", compiler.with_performance), out, every="0 seconds")
    threading.Timer(3, lambda: os.kill(os.getpid(), signal.SIGTERM)).start()
    runner.serve([query], 60)
    assert not query.isActive
    assert runner.derived(spark, out).select("span_id").distinct().count() == 200
