"""Metadata, patterns, scopes, rollups and gates on hand-made spans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spanloom import schemas
from spanloom.operators import gate, registry, rollup
from spanloom.plans import compiler, specs
from spanloom.sources import tables

AT = dt.datetime(2024, 1, 1, 12, 0, 0)


def spans(spark, *rows):
    base = {f.name: "" for f in schemas.RAW_SPANS} | {"stage_order": None, "started_at": AT, "ended_at": AT + dt.timedelta(milliseconds=250), "recorded_at": AT, "solution_id": "s", "span_type": "model_call", "scope": "component", "span_status": "ok", "trace_id": "t", "environment": "prod"}
    made = [base | {"span_id": str(i)} | row for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(row[f.name] for f in schemas.RAW_SPANS) for row in made], schemas.RAW_SPANS)


def values(frame):
    return {(row.span_id, row.scope, row.metric): row.value for row in frame.collect()}


def performance(spark, *rows):
    return values(compiler.emit(compiler.with_performance(spans(spark, *rows)), specs.of_lens("performance")))


@pytest.mark.parametrize("metadata", ["", "{}", r"\N", "{bad", "[1, 2]", "null"])
def test_unreadable_metadata_has_no_keys(spark, metadata):
    got = performance(spark, {"metadata": metadata})
    assert got == {("0", "component", "latency"): 250.0, ("0", "component", "error_rate"): 0.0, ("0", "component", "timeout_count"): 0.0}


@pytest.mark.parametrize(("value", "expected"), [('"12"', 12.0), ("true", 1.0), ("2.5", 2.5), ('"many"', None), ("null", None)])
def test_numbers(spark, value, expected):
    assert performance(spark, {"metadata": '{"retry_count": %s}' % value}).get(("0", "component", "retry_count")) == expected


@pytest.mark.parametrize(("value", "expected"), [("true", 1.0), ("1", 1.0), ('"True"', 1.0), ("false", 0.0), ('"no"', 0.0), ("null", None)])
def test_flags(spark, value, expected):
    assert performance(spark, {"metadata": '{"rate_limit_hit": %s}' % value}).get(("0", "component", "rate_limit_hit")) == expected


def test_strict_number_raises(spark):
    from spanloom.functions import metadata

    frame = spans(spark, {"metadata": '{"a": "x"}'}).withColumn("md", metadata.parsed("metadata"))
    assert frame.select(metadata.number("md", "a")).first()[0] is None
    with pytest.raises(Exception, match="no number"):
        frame.select(metadata.number("md", "a", strict=True)).collect()


def test_zero_and_negative_latency(spark):
    md = '{"usage": {"output_tokens": 5}, "first_token_at": "2024-01-01 12:00:00.100"}'
    got = performance(spark, {"ended_at": AT, "metadata": md}, {"ended_at": AT - dt.timedelta(seconds=1), "metadata": md})
    assert ("0", "component", "token_throughput") not in got
    assert got["1", "component", "latency"] == -1000.0
    assert got["1", "component", "token_throughput"] == -5.0
    assert got["0", "component", "time_to_first_token"] == 100.0


def test_scopes(spark):
    got = performance(spark, {"scope": "", "span_type": "agent"}, {"scope": "solution", "span_type": "solution", "endpoint": "/v1"}, {"scope": "solution", "span_type": "solution"})
    assert {(i, scope) for i, scope, metric in got if metric == "latency"} == {("0", "agent"), ("1", "solution"), ("1", "endpoint"), ("2", "solution")}


def test_paths_are_blank_below_the_scope(spark):
    row = {"endpoint": "/v1", "workflow_id": "w", "agent_id": "a", "component_id": "c", "component_type": "model"}
    frame = compiler.emit(compiler.with_performance(spans(spark, row | {"scope": "workflow", "span_type": "workflow"}, row)), specs.of_lens("performance")).where("metric = 'latency'")
    assert [tuple(r) for r in frame.orderBy("span_id").select(*schemas.PATH, "component_type").collect()] == [("s", "/v1", "w", "", "", ""), ("s", "/v1", "w", "a", "c", "model")]


def test_unknown_component_costs_nothing(spark):
    rates = tables.StaticPricing({"m": {"component_type": "model", "pricing": {"input_per_1k": 1.0, "output_per_1k": 2.0, "cached_per_1k": 0.5}}}).load(spark)
    md = '{"usage": {"input_tokens": 1000, "output_tokens": 500, "cached_tokens": 200}, "retry_count": 2}'
    got = values(compiler.emit(compiler.with_cost(spans(spark, {"component_id": "m", "metadata": md, "span_status": "error"}, {"component_id": "x", "metadata": md}, {"component_id": "m"}), rates), specs.of_lens("cost")))
    assert got["0", "component", "cost"] == pytest.approx(2.1)
    assert got["0", "component", "wasted_cost"] == pytest.approx(2.1)
    assert got["0", "component", "retry_cost"] == pytest.approx(4.2)
    assert got["0", "component", "cost_per_token"] == pytest.approx(2.1 / 1500)
    assert got["0", "component", "cache_savings"] == pytest.approx(0.1)
    assert got["1", "component", "cost"] == 0.0
    assert ("2", "component", "cost_per_token") not in got


def test_catalog(spark):
    rows = {row.metric_name: row for row in specs.catalog(spark).collect()}
    assert len(rows) == 22
    assert rows["latency"].required_span_types == ["*"] and len(rows["latency"].applicable_scopes) == 5
    assert rows["throughput"].applicable_scopes == ["agent", "workflow", "endpoint", "solution"]
    assert rows["budget_utilization"].applicable_scopes == ["solution"]
    assert len(specs.SPECS) == 50 and sum(spec.per_span for spec in specs.SPECS) == 42
    odd = specs.MetricSpec("latency", "cost", "any_span", specs.p.column_latency, "s", "1h", True)
    with pytest.raises(ValueError, match="twice"):
        specs.catalog(spark, (*specs.SPECS, odd))
    with pytest.raises(KeyError, match="not registered"):
        specs.MetricSpec("x", "cost", "nowhere", specs.p.column_latency, "s", "1h").predicate


def derived(spark, n=40):
    rows = [{"ended_at": AT + dt.timedelta(seconds=7 * i, milliseconds=i), "solution_id": f"s{i % 2}", "endpoint": f"/{i % 3}"} for i in range(n)]
    return compiler.emit(compiler.with_performance(spans(spark, *rows)), specs.of_lens("performance"))


def test_states_of_parts_merge_to_the_whole(spark):
    rows = derived(spark)
    late = F.col("span_id").cast("int") % 3 == 0  # late rows add states to minutes that have some
    keys = ["metric", "solution_id", F.date_trunc("hour", "ts").alias("hour")]
    whole = rollup.read(rollup.base(rows), keys, (0.5,))
    parts = rollup.read(rollup.base(rows.where(late)).unionByName(rollup.base(rows.where(~late))), keys, (0.5,))
    as_rows = lambda f: sorted((r.metric, r.solution_id, r["count"], round(r.sum_value, 6), r.min_value, r.max_value, round(r.avg_value, 9)) for r in f.collect())
    assert as_rows(whole) == as_rows(parts)
    assert as_rows(rollup.read(rollup.cascade(rollup.base(rows)), keys, ())) == as_rows(whole)


def test_sketch_rank_error(spark):
    rows = derived(spark, 400).where("metric = 'latency'")
    got = rollup.read(rollup.base(rows), ["metric"], (0.5,)).first().p50
    below = rows.where(F.col("value") < got).count() / rows.count()
    assert abs(below - 0.5) < 0.05


def test_gate_is_monotonous(spark):
    frame = compiler.with_performance(spans(spark, {"component_id": "a"}, {"component_id": "b"}))
    every = compiler.emit(frame, specs.of_lens("performance"))
    keys = every.select(*gate.KEY).distinct()
    one = keys.where("component_id = 'a' AND metric = 'latency'")
    assert values(compiler.emit(frame, specs.of_lens("performance"), keys)) == values(every)
    assert set(values(compiler.emit(frame, specs.of_lens("performance"), one))) == {("0", "component", "latency")}
    assert compiler.emit(frame, specs.of_lens("performance"), one.limit(0)).count() == 0


def test_sampling_bounds(spark):
    frame = spark.range(500).select(F.col("id").cast("string").alias("span_id"))
    assert gate.sampled(frame, 1).count() == 500 and gate.sampled(frame, 0).count() == 0
    assert 80 < gate.sampled(frame, 0.25).count() < 170


def test_slots():
    assert [tables.slots_of_worker(i, 3) for i in range(3)] == [[0, 1, 2, 3, 4, 5], [6, 7, 8, 9, 10], [11, 12, 13, 14, 15]]


def test_seeding_adds_only_what_is_absent(spark):
    frame = spans(spark, {"endpoint": "/v1", "component_id": "c", "component_type": "model"})
    first = registry.reconcile(frame, specs.catalog(spark))
    again = registry.reconcile(frame, specs.catalog(spark), first)
    assert again["thresholds"].count() == first["thresholds"].count() > 0
    assert again["observations"].agg(F.sum("sample_count")).first()[0] == 2 * first["observations"].agg(F.sum("sample_count")).first()[0]
    kept = registry.merge(first["entities"].withColumn("path", F.lit("/old")), first["entities"], registry.ENTITY_KEY)
    assert {row.path for row in kept.collect()} == {"/old"}


def test_csv(spark, tmp_path):
    path = tmp_path / "spans.csv"
    names = [f.name for f in schemas.RAW_SPANS]
    row = {n: "" for n in names} | {"span_id": "x", "started_at": "2024-01-01 12:00:00", "ended_at": "2024-01-01 12:00:00.500", "stage_order": r"\N", "metadata": '"{""retry_count"": 1}"'}
    path.write_text(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
    got = tables.span_csv(spark, str(path)).first()
    assert got.span_id == "x" and got.endpoint == "" and got.stage_order is None and got.metadata == '{"retry_count": 1}'
    assert (got.ended_at - got.started_at).total_seconds() == 0.5


def test_json_jobs_and_settings(spark, tmp_path):
    assert [r.input for r in tables.jobs_from_text(spark, '[{"input": "a"}, {"input": "b"}]', "input string").collect()] == ["a", "b"]
    assert [r.input for r in tables.jobs_from_text(spark, '{"input": "a"}\n{"input": "b"}', "input string").collect()] == ["a", "b"]
    (tmp_path / "c.json").write_text('{"runtime": {"batch": 1, "poll": 2}}')
    assert tables.read_settings(str(tmp_path / "c.json"), {"runtime": {"batch": 5}}) == {"runtime": {"batch": 5, "poll": 2}}
