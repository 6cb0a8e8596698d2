"""From spans and specs to one row per span, scope and metric.

The plan reads spans once, parses their metadata once, computes all metrics of
a lens side by side in one projection, and turns them to rows with one
generator; without a gate there is no shuffle, and Python runs only where a
safety or quality model is asked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom import schemas
from spanloom.functions import metadata, sides
from spanloom.operators import gate
from spanloom.plans import specs as declared


def path_columns(scope: Column) -> dict[str, Column]:
    """The path of a row at a scope: deeper ids are blank; solution and endpoint keep the endpoint."""
    blank = {
        "workflow_id": ("solution", "endpoint"),
        "agent_id": ("solution", "endpoint", "workflow"),
        "component_id": ("solution", "endpoint", "workflow", "agent"),
        "component_type": ("solution", "endpoint", "workflow", "agent"),
    }
    return {name: F.when(scope.isin(*scopes), F.lit("")).otherwise(F.col(name)) for name, scopes in blank.items()}


def scopes_of() -> Column:
    """The scopes of a span: its own, or its type; a solution with an endpoint counts for that, too."""
    level = F.when(F.coalesce(F.col("scope"), F.lit("")) != "", F.col("scope")).otherwise(F.col("span_type"))
    both = (level == "solution") & (F.coalesce(F.col("endpoint"), F.lit("")) != "")
    return F.when(both, F.array(F.lit("solution"), F.lit("endpoint"))).otherwise(F.array(level))


def spans_of_lens(spans: DataFrame, lens: str) -> DataFrame:
    """The lens's span types: a filter that reaches the scan."""
    types = declared.SPAN_TYPES[lens]
    return spans.where(F.col("span_type").isin(*types)) if types else spans


def with_performance(spans: DataFrame) -> DataFrame:
    """Adds md and the performance lens's context."""
    read = spans.withColumn("md", metadata.parsed("metadata"))
    at = {key: metadata.moment(metadata.text("md", key)) for key in ("first_token_at", "enqueued_at", "scheduled_at")}
    latency = metadata.millis(F.col("ended_at"), F.col("started_at"))
    return read.withColumns({
        "latency_ms": latency,
        "latency_s": latency / 1000.0,
        "ttft_ms": F.round(metadata.millis(at["first_token_at"], F.col("started_at")), 3),
        "queue_wait_ms": F.round(metadata.millis(at["scheduled_at"], at["enqueued_at"]), 3),
        "scheduling_delay_ms": F.round(metadata.millis(F.col("started_at"), at["scheduled_at"]), 3),
        "output_tokens_md": metadata.number("md", "usage.output_tokens"),
    })


def with_cost(spans: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds md and the cost lens's context; rates: component_id and pricing (map of doubles), a row for each component."""
    read = spans.withColumn("md", metadata.parsed("metadata"))
    priced = read.join(sides.small(rates.select("component_id", "pricing")), "component_id", "left")
    rate = lambda key: F.coalesce(F.col("pricing")[key], F.lit(0.0))
    amounts = priced.withColumns({
        "input_tokens": metadata.amount("md", "usage.input_tokens"),
        "output_tokens": metadata.amount("md", "usage.output_tokens"),
        "reasoning_tokens": metadata.amount("md", "usage.reasoning_tokens"),
        "cached_tokens": metadata.amount("md", "usage.cached_tokens"),
        "embedding_tokens": metadata.amount("md", "embedding_tokens"),
        "search_units": metadata.amount("md", "search_units"),
        "retries": metadata.amount("md", "retry_count"),
        "rate_in": rate("input_per_1k"), "rate_out": rate("output_per_1k"), "rate_cached": rate("cached_per_1k"),
        "rate_call": rate("per_call"), "rate_query": rate("per_query"),
    })
    thousand = F.lit(1000.0)
    raw = amounts.withColumns({
        "total_tokens": F.col("input_tokens") + F.col("output_tokens"),
        "in_usd": F.col("input_tokens") / thousand * F.col("rate_in"),
        "out_usd": F.col("output_tokens") / thousand * F.col("rate_out"),
        "cache_usd": F.col("cached_tokens") / thousand * F.col("rate_cached"),
        "embed_usd": F.col("embedding_tokens") / thousand * F.col("rate_in"),
    })
    kind = F.col("span_type")
    usd = (
        F.when(kind == "model_call", F.col("in_usd") + F.col("out_usd") + F.col("cache_usd"))
        .when(kind == "embedding", F.col("embed_usd")).when(kind == "tool_call", F.col("rate_call")).when(kind == "retrieval", F.col("rate_query")).otherwise(0.0)
    )
    failed = F.lower("span_status").isin("error", "timeout")
    return raw.withColumn("usd", usd).withColumns({
        "cost": F.round("usd", 8),
        "input_cost": F.round("in_usd", 8),
        "output_cost": F.round("out_usd", 8),
        "tool_api_cost": F.round("rate_call", 8),
        "embedding_cost": F.round("embed_usd", 8),
        "wasted_cost": F.when(failed, F.round("usd", 8)).otherwise(0.0),
        "retry_cost": F.round(F.col("usd") * F.col("retries"), 8),
        "cost_per_token": F.round(F.try_divide("usd", "total_tokens"), 10),
        "cache_savings": F.round(F.col("cached_tokens") / thousand * F.greatest(F.lit(0.0), F.col("rate_in") - F.col("rate_cached")), 8),
    })


def emit(context: DataFrame, specs: Sequence[declared.MetricSpec], active: DataFrame | None = None) -> DataFrame:
    """Derived rows of the specs over a lens's context.

    active: the toggles' keys (gate.KEY); None leaves all on. It is read
    several times, so store it first (sides.stored) if it takes work to
    compute. Spans none of whose paths has an active metric of these specs are
    dropped first.
    """
    specs = [spec for spec in specs if spec.per_span]
    item = lambda spec: F.struct(F.lit(spec.metric).alias("metric"), F.when(spec.predicate.column(), spec.value()).cast("double").alias("value"), (spec.meta() if spec.meta else F.lit(None)).cast("string").alias("metric_meta"))
    base = [name for name in ("span_id", "trace_id", "parent_span_id", "solution_id", "endpoint", "workflow_id", "agent_id", "component_id", "component_type", "environment", "started_at", "ended_at")]
    if active is not None:
        active = active.where(F.col("metric").isin([spec.metric for spec in specs]))
        context = gate.before(context, active, scopes_of(), path_columns)
    wide = context.select(*base, scopes_of().alias("scopes"), F.inline(F.array(*(item(spec) for spec in specs)))).where("value IS NOT NULL")
    rows = wide.select(*base, F.explode("scopes").alias("scope"), "metric", "value", "metric_meta")
    rows = rows.withColumns(path_columns(F.col("scope")))
    if active is not None:
        rows = gate.exactly(rows, active)
    return rows.select(
        "span_id", "trace_id", "parent_span_id", "scope", *schemas.PATH, "component_type", "environment", F.col("ended_at").alias("ts"),
        "metric", "value", F.lit(None).cast("float").alias("confidence"), "metric_meta", F.col("started_at").alias("start_ts"), F.col("ended_at").alias("end_ts"),
    )


def skipped(context: DataFrame, specs: Sequence[declared.MetricSpec]) -> DataFrame:
    """metric, skipped: on how many spans each metric applies but has no value, the most first."""
    specs = [spec for spec in specs if spec.per_span]
    counts = context.agg(*(F.count_if(spec.predicate.column() & spec.value().isNull()).alias(spec.metric) for spec in specs))
    return counts.unpivot([], [spec.metric for spec in specs], "metric", "skipped").orderBy(F.desc("skipped"), "metric")
