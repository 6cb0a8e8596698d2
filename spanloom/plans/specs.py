"""Declared metrics: which spans they apply to and what their value is."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schemas
from spanloom.functions import patterns as p
from spanloom.functions import predicates

LENSES = ("performance", "cost", "safety", "quality")
#: Span types that a lens reads; none for all.
SPAN_TYPES = {
    "performance": (),
    "cost": ("model_call", "embedding", "tool_call", "retrieval"),
    "safety": ("model_call",),
    "quality": ("model_call", "tool_call", "retrieval", "validation", "skill_exec"),
}


@dataclass(frozen=True)
class MetricSpec:
    """value and meta build Columns over the lens's context; per_span=False marks metrics that are computed when read."""

    metric: str
    lens: str
    applies: str
    value: Callable[[], Column]
    unit: str
    window: str
    threshold: bool = False
    per_span: bool = True
    meta: Callable[[], Column] | None = None

    @property
    def predicate(self) -> predicates.Predicate:
        if self.applies not in predicates.ALL:
            raise KeyError(f"predicate {self.applies!r} of metric {self.metric!r} is not registered")
        return predicates.ALL[self.applies]


def _ctx(name: str) -> Callable[[], Column]:
    return lambda: p.ctx_value(name)


def _numeric(path: str) -> Callable[[], Column]:
    return lambda: p.metadata_numeric(path)


_PERFORMANCE = (
    MetricSpec("latency", "performance", "any_span", p.column_latency, "ms", "5m", True),
    MetricSpec("error_rate", "performance", "any_span", lambda: p.status_flag("error", "timeout"), "ratio", "5m", True),
    MetricSpec("timeout_count", "performance", "any_span", lambda: p.status_flag("timeout"), "count", "5m"),
    MetricSpec("time_to_first_token", "performance", "llm_call", _ctx("ttft_ms"), "ms", "5m", True),
    MetricSpec("queue_wait_time", "performance", "queued_op", _ctx("queue_wait_ms"), "ms", "5m"),
    MetricSpec("scheduling_delay", "performance", "orchestrated", _ctx("scheduling_delay_ms"), "ms", "5m"),
    MetricSpec("retry_count", "performance", "retryable", _numeric("retry_count"), "count", "15m", True),
    MetricSpec("retry_delay", "performance", "retryable", _numeric("retry_delay_ms"), "ms", "15m"),
    MetricSpec("rate_limit_hit", "performance", "rate_limited", lambda: p.metadata_bool("rate_limit_hit"), "ratio", "5m"),
    MetricSpec("rate_limit_wait", "performance", "rate_limited", _numeric("rate_limit_wait_ms"), "ms", "5m"),
    MetricSpec("records_processed", "performance", "batch_op", _numeric("records_processed"), "count", "5m"),
    MetricSpec("token_throughput", "performance", "llm_call", lambda: p.ratio(F.col("output_tokens_md"), F.col("latency_s")), "tok/sec", "5m"),
    MetricSpec("throughput", "performance", "levels", p.aggregation_derived, "ops/sec", "5m", True, False),
    MetricSpec("concurrency", "performance", "levels", p.aggregation_derived, "gauge", "5m", False, False),
)
_COST = (
    MetricSpec("input_tokens", "cost", "llm_call", _ctx("input_tokens"), "count", "1h"),
    MetricSpec("output_tokens", "cost", "llm_call", _ctx("output_tokens"), "count", "1h"),
    MetricSpec("total_tokens", "cost", "llm_call", _ctx("total_tokens"), "count", "1h", True),
    MetricSpec("cached_tokens", "cost", "llm_call", _ctx("cached_tokens"), "count", "1h"),
    MetricSpec("reasoning_tokens", "cost", "llm_call", _ctx("reasoning_tokens"), "count", "1h"),
    MetricSpec("embedding_tokens", "cost", "cost_embedding", _ctx("embedding_tokens"), "count", "1h"),
    MetricSpec("search_units", "cost", "cost_kb", _ctx("search_units"), "count", "1h"),
    MetricSpec("cost", "cost", "billable", _ctx("cost"), "USD", "1d", True),
    MetricSpec("input_cost", "cost", "llm_call", _ctx("input_cost"), "USD", "1d"),
    MetricSpec("output_cost", "cost", "llm_call", _ctx("output_cost"), "USD", "1d"),
    MetricSpec("tool_api_cost", "cost", "cost_tool", _ctx("tool_api_cost"), "USD", "1d"),
    MetricSpec("embedding_cost", "cost", "cost_embedding", _ctx("embedding_cost"), "USD", "1d"),
    MetricSpec("infrastructure_cost", "cost", "sol_wf", p.aggregation_derived, "USD", "1d", False, False),
    MetricSpec("cost_per_outcome", "cost", "sol_wf", p.aggregation_derived, "USD", "1d", True, False),
    MetricSpec("wasted_cost", "cost", "billable", _ctx("wasted_cost"), "USD", "1d"),
    MetricSpec("retry_cost", "cost", "billable", _ctx("retry_cost"), "USD", "1d"),
    MetricSpec("cost_per_token", "cost", "llm_call", _ctx("cost_per_token"), "USD/token", "1h"),
    MetricSpec("cache_savings", "cost", "llm_call", _ctx("cache_savings"), "USD", "1d"),
    MetricSpec("cost_per_record", "cost", "sol_wf", p.aggregation_derived, "USD", "1d", False, False),
    MetricSpec("budget_utilization", "cost", "solution_only", p.aggregation_derived, "0-1", "1h", True, False),
    MetricSpec("burn_rate", "cost", "sol_wf", p.aggregation_derived, "USD/hr", "1h", True, False),
    MetricSpec("projected_cost", "cost", "solution_only", p.aggregation_derived, "USD", "1d", False, False),
)
_SAFETY = (
    MetricSpec("pii_detected", "safety", "llm_call", _ctx("pii_detected"), "ratio", "1h", True, True, lambda: F.col("pii_meta")),
    MetricSpec("prompt_injection_detected", "safety", "llm_call", _ctx("prompt_injection_detected"), "ratio", "1h", True, True, lambda: F.col("prompt_injection_meta")),
    MetricSpec("toxicity_detected", "safety", "llm_call", _ctx("toxicity_detected"), "ratio", "1h", True, True, lambda: F.col("toxicity_meta")),
)
_QUALITY = (
    *(MetricSpec(name, "quality", "llm_call", _ctx(name), "ratio", "1h", True, True, lambda: F.col("generation_meta")) for name in ("faithfulness", "coherence", "completeness")),
    MetricSpec("context_relevance", "quality", "retrieval_op", _ctx("context_relevance"), "ratio", "1h", True, True, lambda: F.col("retrieval_meta")),
    MetricSpec("chunk_utilization", "quality", "retrieval_op", _ctx("chunk_utilization"), "ratio", "1h", False, True, lambda: F.col("retrieval_meta")),
    MetricSpec("data_completeness", "quality", "data_op", _ctx("data_completeness"), "ratio", "1h", True),
    MetricSpec("data_accuracy", "quality", "validated_op", _ctx("data_accuracy"), "ratio", "1h", True, True, lambda: F.col("accuracy_meta")),
    MetricSpec("schema_conformance", "quality", "schema_checked", _ctx("schema_conformance"), "ratio", "1h", True),
    MetricSpec("format_correctness", "quality", "output_bearing", _ctx("format_correctness"), "ratio", "1h", True),
    MetricSpec("constraint_satisfaction", "quality", "any_span", _ctx("constraint_satisfaction"), "ratio", "1h", False, True, lambda: F.col("constraint_meta")),
    MetricSpec("tool_call_validity", "quality", "tool_op", _ctx("tool_call_validity"), "ratio", "1h", True, True, lambda: F.col("tool_meta")),
)
SPECS: tuple[MetricSpec, ...] = (*_PERFORMANCE, *_COST, *_SAFETY, *_QUALITY)


def of_lens(lens: str, specs: Sequence[MetricSpec] = SPECS) -> tuple[MetricSpec, ...]:
    return tuple(spec for spec in specs if spec.lens == lens)


def catalog(spark: SparkSession, specs: Sequence[MetricSpec] = SPECS) -> DataFrame:
    """A row for each metric that can have thresholds. Two specs of one name must say the same."""
    rows: dict[str, tuple] = {}
    for spec in specs:
        if not spec.threshold:
            continue
        predicate = spec.predicate
        row = (spec.metric, spec.lens, list(predicate.types) or ["*"], list(predicate.applicable_scopes()), spec.unit, spec.window, "gt")
        if rows.setdefault(spec.metric, row) != row:
            raise ValueError(f"metric {spec.metric!r} is declared twice, differently")
    return spark.createDataFrame(list(rows.values()), schemas.CATALOG)


def upserted(old: DataFrame, new: DataFrame) -> DataFrame:
    """A stored catalog after new rows: those of one metric name are replaced whole, all others stay."""
    return old.join(new.select("metric_name"), "metric_name", "left_anti").select(old.columns).unionByName(new)


def write_catalog(spark: SparkSession, folder: str, specs: Sequence[MetricSpec] = SPECS) -> DataFrame:
    """Puts the specs' rows into the catalog at folder, a version a call, and gives what is there now.

    The newest version that Spark finished counts, so a write that fails changes nothing.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place)
    names = sorted(status.getPath().getName() for status in store.listStatus(place))
    whole = [name for name in names if name.startswith("version=") and store.exists(spark._jvm.org.apache.hadoop.fs.Path(place, f"{name}/_SUCCESS"))]
    rows = catalog(spark, specs)
    if whole:
        rows = upserted(spark.read.schema(schemas.CATALOG).parquet(f"{folder}/{whole[-1]}"), rows)
    number = int(names[-1][len("version=") :]) + 1 if names else 0
    rows.write.parquet(f"{folder}/version={number:012d}")
    return spark.read.schema(schemas.CATALOG).parquet(f"{folder}/version={number:012d}")


def dump(spark: SparkSession, specs: Sequence[MetricSpec] = SPECS) -> DataFrame:
    """All specs as rows."""
    rows = [(s.metric, s.lens, s.applies, s.unit, s.window, s.threshold, s.per_span) for s in specs]
    return spark.createDataFrame(rows, "metric string, lens string, applies string, unit string, window string, threshold boolean, per_span boolean")
