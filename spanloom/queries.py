"""Registered queries over the driver's tables, with DuckDB SQL of the same meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schemas
from spanloom.functions import sides
from spanloom.operators import coverage, evaluation, gate, quality, registry, rollup, safety
from spanloom.plans import compiler
from spanloom.plans import specs as declared
from spanloom.sources import fixtures, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE_SQL[name] = sql
        return query

    return add


#: The fixture spans in SQL, with the values of their metadata as columns; ok_md tells whether the metadata can be read.
SPANS = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CAST(round(value * 1000) AS BIGINT) AS micros FROM events),
t AS (
  SELECT *, CASE k % 9 WHEN 0 THEN 'solution' WHEN 1 THEN 'workflow' WHEN 2 THEN 'agent' WHEN 3 THEN 'model_call' WHEN 4 THEN 'tool_call'
    WHEN 5 THEN 'embedding' WHEN 6 THEN 'retrieval' WHEN 7 THEN 'validation' ELSE 'skill_exec' END AS span_type,
    NOT (event_id % 13 = 0 OR event_id % 17 = 0) AS ok_md FROM e),
s AS (
  SELECT *, 'ev-' || event_id AS span_id, 'tr-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS trace_id,
    ts AS started_at, ts + to_microseconds(micros) AS ended_at, micros / 1000.0 AS latency_ms,
    CASE WHEN span_type IN ('solution', 'workflow', 'agent') THEN span_type ELSE 'component' END AS scope,
    CASE WHEN event_type <> 'error' THEN 'ok' WHEN k % 10 < 7 THEN 'error' ELSE 'timeout' END AS span_status,
    'sol_' || (user_id % 2) AS solution_id, CASE WHEN user_id % 5 = 0 THEN '' ELSE '/v1/' || event_type END AS endpoint,
    CASE WHEN span_type = 'solution' THEN '' ELSE 'wf_' || (user_id % 3) END AS workflow_id,
    CASE WHEN span_type IN ('solution', 'workflow') THEN '' ELSE 'agt_' || (user_id % 8) END AS agent_id,
    CASE span_type WHEN 'model_call' THEN CASE WHEN event_id % 2 = 0 THEN 'model_gpt4o' ELSE 'model_claude' END WHEN 'embedding' THEN 'model_embed'
      WHEN 'tool_call' THEN 'tool_websearch' WHEN 'retrieval' THEN 'kb_product_docs' WHEN 'validation' THEN 'func_validate' WHEN 'skill_exec' THEN 'skill_ner' ELSE '' END AS component_id,
    CASE WHEN user_id % 10 < 8 THEN 'prod' ELSE 'staging' END AS environment,
    CASE WHEN ok_md THEN 100.0 + k ELSE 0 END AS it, CASE WHEN ok_md THEN 10.0 * k ELSE 0 END AS ot, CASE WHEN ok_md THEN k * 1.0 ELSE 0 END AS ct,
    CASE WHEN ok_md THEN k % 7 * 1.0 ELSE 0 END AS rt, CASE WHEN ok_md THEN 50.0 + k ELSE 0 END AS emb, CASE WHEN ok_md THEN k % 5 * 1.0 ELSE 0 END AS su,
    CASE WHEN ok_md THEN k % 4 * 1.0 ELSE 0 END AS rc FROM t),
r AS (
  SELECT *, CASE component_id WHEN 'model_gpt4o' THEN 0.005 WHEN 'model_claude' THEN 0.003 WHEN 'model_embed' THEN 0.00002 ELSE 0 END AS r_in,
    CASE WHEN component_id IN ('model_gpt4o', 'model_claude') THEN 0.015 ELSE 0 END AS r_out,
    CASE component_id WHEN 'model_gpt4o' THEN 0.0025 WHEN 'model_claude' THEN 0.0003 ELSE 0 END AS r_cached,
    CASE component_id WHEN 'tool_websearch' THEN 0.005 ELSE 0 END AS r_call, CASE component_id WHEN 'kb_product_docs' THEN 0.0001 ELSE 0 END AS r_query FROM s),
c AS (
  SELECT *, CAST(it AS DOUBLE) / 1000 * CAST(r_in AS DOUBLE) AS in_usd, CAST(ot AS DOUBLE) / 1000 * CAST(r_out AS DOUBLE) AS out_usd, CAST(ct AS DOUBLE) / 1000 * CAST(r_cached AS DOUBLE) AS cache_usd,
    CAST(emb AS DOUBLE) / 1000 * CAST(r_in AS DOUBLE) AS embed_usd FROM r),
u AS (
  SELECT *, CAST(CASE span_type WHEN 'model_call' THEN in_usd + out_usd + cache_usd WHEN 'embedding' THEN embed_usd WHEN 'tool_call' THEN r_call WHEN 'retrieval' THEN r_query ELSE 0 END AS DOUBLE) AS usd FROM c),
x AS (SELECT *, unnest(CASE WHEN scope = 'solution' AND endpoint <> '' THEN ['solution', 'endpoint'] ELSE [scope] END) AS at_scope FROM u)
"""

#: For each per-span metric of the performance and cost lenses: the spans it applies to and its value, in SQL.
_IN = lambda *types: "span_type IN (" + ", ".join(f"'{t}'" for t in types) + ")"
_LLM, _BILLABLE = _IN("model_call"), _IN("model_call", "embedding", "tool_call", "retrieval")
METRIC_SQL = {
    "latency": ("TRUE", "round(latency_ms, 3)"),
    "error_rate": ("TRUE", "CASE WHEN span_status IN ('error', 'timeout') THEN 1.0 ELSE 0.0 END"),
    "timeout_count": ("TRUE", "CASE WHEN span_status = 'timeout' THEN 1.0 ELSE 0.0 END"),
    "time_to_first_token": (f"{_LLM} AND ok_md", "k"),
    "queue_wait_time": (f"{_IN('agent', 'workflow')} AND ok_md", "k"),
    "scheduling_delay": (f"{_IN('workflow')} AND ok_md", "k"),
    "retry_count": (f"{_IN('model_call', 'tool_call', 'retrieval', 'embedding', 'validation', 'agent')} AND ok_md", "k % 4"),
    "retry_delay": (f"{_IN('model_call', 'tool_call', 'retrieval', 'embedding', 'validation', 'agent')} AND ok_md", "k * 5"),
    "rate_limit_hit": (f"{_IN('model_call', 'tool_call')} AND ok_md", "CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.0 END"),
    "rate_limit_wait": (f"{_IN('model_call', 'tool_call')} AND ok_md", "k"),
    "records_processed": (f"{_IN('validation', 'skill_exec')} AND ok_md", "k"),
    "token_throughput": (f"{_LLM} AND ok_md AND latency_ms <> 0", "CAST(10.0 * k / (latency_ms / 1000.0) AS DECIMAL(18, 4))"),
    "input_tokens": (_LLM, "it"),
    "output_tokens": (_LLM, "ot"),
    "total_tokens": (_LLM, "it + ot"),
    "cached_tokens": (_LLM, "ct"),
    "reasoning_tokens": (_LLM, "rt"),
    "embedding_tokens": (_IN("embedding"), "emb"),
    "search_units": (_IN("retrieval"), "su"),
    "cost": (_BILLABLE, "round(usd, 8)"),
    "input_cost": (_LLM, "round(in_usd, 8)"),
    "output_cost": (_LLM, "round(out_usd, 8)"),
    "tool_api_cost": (_IN("tool_call"), "r_call"),
    "embedding_cost": (_IN("embedding"), "round(embed_usd, 8)"),
    "wasted_cost": (_BILLABLE, "CASE WHEN span_status IN ('error', 'timeout') THEN round(usd, 8) ELSE 0.0 END"),
    "retry_cost": (_BILLABLE, "round(usd * rc, 8)"),
    "cost_per_token": (f"{_LLM} AND it + ot > 0", "round(usd / CAST(it + ot AS DOUBLE), 10)"),
    "cache_savings": (_LLM, "round(CAST(ct AS DOUBLE) / 1000 * greatest(0.0, CAST(r_in AS DOUBLE) - CAST(r_cached AS DOUBLE)), 8)"),
}


def derived(spark: SparkSession, sf_dir: str, lens: str, active: DataFrame | None = None, only: str | None = None) -> DataFrame:
    """The lens's rows over the fixture spans."""
    spans = compiler.spans_of_lens(fixtures.spans_from_events(spark, sf_dir), lens)
    if lens == "performance":
        context = compiler.with_performance(spans)
    elif lens == "cost":
        context = compiler.with_cost(spans, tables.StaticPricing(fixtures.PRICES).load(spark))
    else:
        raise KeyError(lens)
    specs = [spec for spec in declared.of_lens(lens) if only in (None, spec.metric)]
    return compiler.emit(context, specs, active)


def _metric(name: str) -> Query:
    spec = next(spec for spec in declared.SPECS if spec.metric == name)
    return lambda spark, sf_dir: derived(spark, sf_dir, spec.lens, only=name).select("span_id", "scope", *schemas.PATH, "metric", "value")


_PATH_SQL = """solution_id, endpoint, CASE WHEN at_scope IN ('solution', 'endpoint') THEN '' ELSE workflow_id END AS workflow_id,
  CASE WHEN at_scope IN ('solution', 'endpoint', 'workflow') THEN '' ELSE agent_id END AS agent_id, CASE WHEN at_scope = 'component' THEN component_id ELSE '' END AS component_id"""

for _name, (_applies, _value) in METRIC_SQL.items():
    ORACLE_SQL[f"metric_{_name}"] = f"{SPANS} SELECT span_id, at_scope AS scope, {_PATH_SQL}, '{_name}' AS metric, CAST({_value} AS DOUBLE) AS value FROM x WHERE {_applies}"
    QUERIES[f"metric_{_name}"] = _metric(_name)


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(spark, sf_dir, "performance").where(F.col("metric").isin("latency", "error_rate"))
    states = rollup.base(rows)
    read = rollup.read(states, ["metric", "solution_id", F.date_trunc("hour", "ts").alias("hour")])
    return read.select("metric", "solution_id", "hour", F.col("count").alias("n"), F.round("sum_value", 3).alias("total"), F.round("avg_value", 6).alias("mean"), F.round("min_value", 3).alias("least"), F.round("max_value", 3).alias("most"), "p50", "p95", "p99")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency and error rate by solution and hour, from one-minute states merged when read."""
    return _hourly(spark, sf_dir)


_HOURLY_SQL = f"""{SPANS}, m AS (
  SELECT solution_id, ended_at, 'latency' AS metric, round(latency_ms, 3) AS value FROM x
  UNION ALL SELECT solution_id, ended_at, 'error_rate', CASE WHEN span_status IN ('error', 'timeout') THEN 1.0 ELSE 0.0 END FROM x)
SELECT metric, solution_id, date_trunc('hour', ended_at) AS hour, count(*) AS n, round(CAST(sum(value) AS DOUBLE), 3) AS total, round(CAST(avg(value) AS DOUBLE), 6) AS mean,
  CAST(min(value) AS DOUBLE) AS least, CAST(max(value) AS DOUBLE) AS most FROM m GROUP BY ALL"""


@register("rollup_hourly", _HOURLY_SQL)
def rollup_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir).drop("p50", "p95", "p99").withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@register("rollup_quantiles")
def rollup_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles from merged KLL sketches."""
    return _hourly(spark, sf_dir).select("metric", "solution_id", "hour", "p50", "p95", "p99")


@register("quantiles_exact", f"""{SPANS} SELECT solution_id, round(quantile_cont(latency_ms, 0.5), 3) AS p50, round(quantile_cont(latency_ms, 0.95), 3) AS p95, round(quantile_cont(latency_ms, 0.99), 3) AS p99 FROM u GROUP BY solution_id""")
def quantiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = compiler.with_performance(fixtures.spans_from_events(spark, sf_dir))
    return spans.groupBy("solution_id").agg(*(F.round(F.percentile("latency_ms", q), 3).alias(f"p{round(q * 100)}") for q in (0.5, 0.95, 0.99)))


@register("rollup_cascade", f"""{SPANS} SELECT at_scope AS scope, solution_id, date_trunc('hour', ended_at) AS ts, count(*) AS n, round(CAST(sum(round(latency_ms, 3)) AS DOUBLE), 3) AS total FROM x GROUP BY ALL""")
def rollup_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes to hours, states to states."""
    states = rollup.cascade(rollup.base(derived(spark, sf_dir, "performance", only="latency")), "hour")
    read = rollup.read(states, ["scope", "solution_id", "ts"], ())
    return read.select("scope", "solution_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("count").alias("n"), F.round("sum_value", 3).alias("total"))


def _states(spark: SparkSession, sf_dir: str, lens: str = "cost") -> DataFrame:
    return rollup.base(derived(spark, sf_dir, lens), quantiles=False)


_COSTS = f"{SPANS}, y AS (SELECT *, round(usd, 8) AS cost FROM x WHERE {_BILLABLE})"


@register("read_cost_by_component", f"{_COSTS} SELECT component_id, round(sum(cost), 9) AS total_cost FROM y GROUP BY component_id")
def read_cost_by_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.cost_by_component(_states(spark, sf_dir))


@register("read_throughput", f"{SPANS} SELECT solution_id, date_trunc('minute', ended_at) AS minute, count(*) / 60.0 AS throughput FROM x GROUP BY ALL")
def read_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.throughput(_states(spark, sf_dir, "performance")).withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@register("read_concurrency", f"{SPANS} SELECT solution_id, date_trunc('minute', ended_at) AS minute, round(CAST(avg(round(latency_ms, 3)) * (count(*) / 60.0) AS DOUBLE), 6) AS concurrency FROM x GROUP BY ALL")
def read_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rollup.concurrency(_states(spark, sf_dir, "performance"))
    return found.select("solution_id", F.col("minute").cast("timestamp_ntz").alias("minute"), F.round("concurrency", 6).alias("concurrency"))


@register("read_overlapping_spans", f"""{SPANS}, ev AS (SELECT solution_id, started_at AS moment, 1 AS delta FROM u UNION ALL SELECT solution_id, ended_at, -1 FROM u),
g AS (SELECT solution_id, moment, sum(delta) AS delta FROM ev GROUP BY solution_id, moment),
o AS (SELECT solution_id, moment, sum(delta) OVER (PARTITION BY solution_id ORDER BY moment) AS n_open FROM g)
SELECT solution_id, date_trunc('hour', moment) AS hour, CAST(max(n_open) AS BIGINT) AS most_open FROM o GROUP BY 1, 2""")
def read_overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rollup.overlapping(fixtures.spans_from_events(spark, sf_dir))
    return found.select("solution_id", F.col("hour").cast("timestamp_ntz").alias("hour"), F.col("most_open").cast("bigint").alias("most_open"))


@register("read_burn_rate", f"{_COSTS} SELECT solution_id, round(sum(cost) / 720.0, 6) AS burn_rate FROM y GROUP BY solution_id")
def read_burn_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.burn_rate(_states(spark, sf_dir), 720).withColumn("burn_rate", F.round("burn_rate", 6))


@register("read_projected_cost", f"{_COSTS} SELECT solution_id, round(sum(cost) / 720.0 * 24.0, 5) AS projected_cost FROM y GROUP BY solution_id")
def read_projected_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.projected_cost(_states(spark, sf_dir), 720, 24).withColumn("projected_cost", F.round("projected_cost", 5))


@register("read_budget_utilization", f"{_COSTS} SELECT solution_id, round(sum(cost) / 100.0, 5) AS budget_utilization FROM y GROUP BY solution_id")
def read_budget_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.budget_utilization(_states(spark, sf_dir), 100).withColumn("budget_utilization", F.round("budget_utilization", 5))


@register("read_infrastructure_cost", f"{SPANS} SELECT solution_id, round(1000.0 * count(*) / (SELECT count(*) FROM x), 6) AS infrastructure_cost FROM x GROUP BY solution_id")
def read_infrastructure_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.infrastructure_cost(_states(spark, sf_dir, "performance"), 1000).withColumn("infrastructure_cost", F.round("infrastructure_cost", 6))


@register("read_cost_per_record", f"{SPANS} SELECT solution_id, round(sum(CASE WHEN {_BILLABLE} THEN round(usd, 8) END) / count(CASE WHEN {_IN('validation', 'skill_exec')} AND ok_md THEN 1 END), 6) AS cost_per_record FROM x GROUP BY solution_id")
def read_cost_per_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _states(spark, sf_dir).unionByName(_states(spark, sf_dir, "performance"))
    return rollup.cost_per(states, "records_processed", "cost_per_record", by="count").withColumn("cost_per_record", F.round("cost_per_record", 6))


@register("read_cost_per_outcome", f"{SPANS} SELECT solution_id, round(sum(CASE WHEN {_BILLABLE} THEN round(usd, 8) END) / sum(CASE WHEN {_IN('validation', 'skill_exec')} AND ok_md THEN k END), 6) AS cost_per_outcome FROM x GROUP BY solution_id")
def read_cost_per_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With records as the outcomes."""
    states = _states(spark, sf_dir).unionByName(_states(spark, sf_dir, "performance"))
    return rollup.cost_per(states, "records_processed", "cost_per_outcome").withColumn("cost_per_outcome", F.round("cost_per_outcome", 6))


def toggles(spark: SparkSession, sf_dir: str, metrics: tuple[str, ...] = ("latency", "error_rate", "retry_count")) -> DataFrame:
    """Keys that are on: paths and metrics the first hex digit of whose SHA-256 is at most 7."""
    paths = derived(spark, sf_dir, "performance", only="latency").select("scope", *schemas.PATH).distinct()
    keys = paths.withColumn("metric", F.explode(F.array(*map(F.lit, metrics))))
    digest = F.sha2(F.concat_ws("/", "scope", *schemas.PATH, "metric"), 256)
    return sides.stored(keys.where(F.substring(digest, 1, 1) <= "7"))


_TOGGLED = f"""{SPANS}, p AS (SELECT *, at_scope AS sc, CASE WHEN at_scope IN ('solution', 'endpoint') THEN '' ELSE workflow_id END AS wf,
  CASE WHEN at_scope IN ('solution', 'endpoint', 'workflow') THEN '' ELSE agent_id END AS ag, CASE WHEN at_scope = 'component' THEN component_id ELSE '' END AS co FROM x),
q AS (SELECT *, CASE WHEN substr(sha256(concat_ws('/', sc, solution_id, endpoint, wf, ag, co, 'latency')), 1, 1) <= '7' THEN 1 ELSE 0 END AS on_latency,
  CASE WHEN substr(sha256(concat_ws('/', sc, solution_id, endpoint, wf, ag, co, 'error_rate')), 1, 1) <= '7' THEN 1 ELSE 0 END AS on_error,
  CASE WHEN substr(sha256(concat_ws('/', sc, solution_id, endpoint, wf, ag, co, 'retry_count')), 1, 1) <= '7' THEN 1 ELSE 0 END AS on_retry FROM p)"""


@register("gated_metrics", f"""{_TOGGLED} SELECT span_id, sc AS scope, 'latency' AS metric, CAST(round(latency_ms, 3) AS DOUBLE) AS value FROM q WHERE on_latency = 1
UNION ALL SELECT span_id, sc, 'error_rate', CAST(CASE WHEN span_status IN ('error', 'timeout') THEN 1.0 ELSE 0.0 END AS DOUBLE) FROM q WHERE on_error = 1
UNION ALL SELECT span_id, sc, 'retry_count', CAST(k % 4 AS DOUBLE) FROM q WHERE on_retry = 1 AND {METRIC_SQL["retry_count"][0]}""")
def gated_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both gates: spans by path first, then rows by their whole key."""
    return derived(spark, sf_dir, "performance", toggles(spark, sf_dir)).select("span_id", "scope", "metric", "value")


@register("gate_first_stage", f"{_TOGGLED} SELECT DISTINCT span_id FROM q WHERE on_latency + on_error + on_retry > 0")
def gate_first_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = fixtures.spans_from_events(spark, sf_dir)
    return gate.before(spans, toggles(spark, sf_dir), compiler.scopes_of(), compiler.path_columns).select("span_id")


@register("gate_needing", f"{_TOGGLED} SELECT DISTINCT span_id FROM q WHERE on_retry = 1")
def gate_needing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = fixtures.spans_from_events(spark, sf_dir)
    return gate.needing(spans, toggles(spark, sf_dir), ["retry_count"], compiler.scopes_of(), compiler.path_columns).select("span_id")


@register("sampled_spans", f"{SPANS} SELECT span_id FROM u WHERE CAST(('0x' || substr(sha256(span_id), 1, 8)) AS BIGINT) % 10000 < 2500")
def sampled_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.sampled(fixtures.spans_from_events(spark, sf_dir), 0.25).select("span_id")


@register("incremental_scan", f"{SPANS} SELECT span_id FROM u WHERE date_trunc('milliseconds', ended_at) > TIMESTAMP '2024-01-20 00:00:00' AND span_type IN ('model_call', 'retrieval')")
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.since(fixtures.spans_from_events(spark, sf_dir), "2024-01-20 00:00:00", span_types=("model_call", "retrieval")).select("span_id")


@register("time_to_live", f"{SPANS} SELECT span_id FROM u WHERE started_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY")
def time_to_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.expired(fixtures.spans_from_events(spark, sf_dir), "started_at", 7, "2024-01-31 00:00:00").select("span_id")


@register("newest_checkpoint", f"{SPANS} SELECT strftime(max(date_trunc('milliseconds', ended_at)), '%Y-%m-%d %H:%M:%S.%g') AS checkpoint FROM u")
def newest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.checkpoint_of(fixtures.spans_from_events(spark, sf_dir))


@register("row_counts", "SELECT 'events' AS table_name, count(*) AS n FROM events UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'conversations', count(*) FROM conversations")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [fixtures.table(spark, sf_dir, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n")) for name in ("events", "documents", "conversations")]
    return counts[0].union(counts[1]).union(counts[2])


@register("metric_catalog")
def metric_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared.catalog(spark)


@register("metric_specs")
def metric_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared.dump(spark)


def _registry(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The registry after all fixture spans; thresholds the first hex digit of whose key's SHA-256 is at most 7 are on."""
    state = registry.reconcile(fixtures.spans_from_events(spark, sf_dir), declared.catalog(spark))
    key = F.concat_ws("/", "scope", *(F.coalesce(F.col(name), F.lit("")) for name in schemas.PATH), "metric_name")
    state["thresholds"] = state["thresholds"].withColumn("is_active", F.substring(F.sha2(key, 256), 1, 1) <= "7")
    return state


_CATALOG_ROWS = [(spec.metric, spec.lens, spec.predicate.types or ("*",), spec.predicate.applicable_scopes()) for spec in declared.SPECS if spec.threshold]
_REGISTRY = f"""{SPANS},
cat AS (SELECT * FROM (VALUES {", ".join(f"('{m}', '{lens}', '{scope}', '{kind}')" for m, lens, types, scopes in _CATALOG_ROWS for scope in scopes for kind in types)}) AS v(metric_name, lens, kind, needs)),
off AS (SELECT DISTINCT metric_name, lens, kind FROM cat),
seen AS (
  SELECT 'solution' AS kind, solution_id AS slug, span_type, ended_at, event_id FROM u UNION ALL SELECT 'endpoint', endpoint, span_type, ended_at, event_id FROM u WHERE endpoint <> ''
  UNION ALL SELECT 'workflow', workflow_id, span_type, ended_at, event_id FROM u WHERE workflow_id <> '' UNION ALL SELECT 'agent', agent_id, span_type, ended_at, event_id FROM u WHERE agent_id <> ''
  UNION ALL SELECT 'component', component_id, span_type, ended_at, event_id FROM u WHERE component_id <> ''),
ent AS (SELECT DISTINCT kind, slug FROM seen),
obs AS (SELECT kind, slug, span_type, count(*) AS sample_count FROM seen GROUP BY kind, slug, span_type),
bind AS (SELECT DISTINCT solution_id, endpoint, nullif(workflow_id, '') AS workflow_id, nullif(agent_id, '') AS agent_id, nullif(component_id, '') AS component_id FROM u WHERE endpoint <> ''),
pth AS (
  SELECT 'solution' AS scope, slug AS solution_id, NULL AS endpoint, NULL AS workflow_id, NULL AS agent_id, NULL AS component_id FROM ent WHERE kind = 'solution'
  UNION SELECT 'endpoint', solution_id, endpoint, NULL, NULL, NULL FROM bind UNION SELECT 'workflow', solution_id, endpoint, workflow_id, NULL, NULL FROM bind WHERE workflow_id IS NOT NULL
  UNION SELECT 'agent', solution_id, endpoint, workflow_id, agent_id, NULL FROM bind WHERE agent_id IS NOT NULL UNION SELECT 'component', solution_id, endpoint, workflow_id, agent_id, component_id FROM bind WHERE component_id IS NOT NULL),
thr AS (
  SELECT off.lens AS category, off.metric_name, pth.*, substr(sha256(concat_ws('/', scope, solution_id, coalesce(endpoint, ''), coalesce(workflow_id, ''), coalesce(agent_id, ''), coalesce(component_id, ''), off.metric_name)), 1, 1) <= '7' AS is_active
  FROM pth JOIN off ON off.kind = pth.scope),
tgt AS (SELECT scope AS kind, CASE scope WHEN 'solution' THEN solution_id WHEN 'endpoint' THEN endpoint WHEN 'workflow' THEN workflow_id WHEN 'agent' THEN agent_id ELSE component_id END AS slug, metric_name, is_active FROM thr),
tot AS (SELECT kind, slug, metric_name, count(*) AS total_paths, sum(CASE WHEN is_active THEN 1 ELSE 0 END) AS active_paths FROM tgt GROUP BY kind, slug, metric_name),
evi AS (SELECT DISTINCT obs.kind, obs.slug, cat.metric_name FROM obs JOIN cat ON cat.kind = obs.kind AND (cat.needs = '*' OR cat.needs = obs.span_type)),
mat AS (
  SELECT ent.kind, ent.slug, off.metric_name, off.lens, CAST(coalesce(total_paths, 0) AS BIGINT) AS total_paths, CAST(coalesce(active_paths, 0) AS BIGINT) AS active_paths,
    CASE WHEN evi.metric_name IS NULL THEN 'dark' WHEN coalesce(active_paths, 0) > 0 THEN 'active' ELSE 'disabled' END AS state
  FROM ent JOIN off ON off.kind = ent.kind LEFT JOIN evi ON evi.kind = ent.kind AND evi.slug = ent.slug AND evi.metric_name = off.metric_name
  LEFT JOIN tot ON tot.kind = ent.kind AND tot.slug = ent.slug AND tot.metric_name = off.metric_name),
els AS (
  SELECT kind, slug, lens, count(*) AS total_metrics, count(*) FILTER (WHERE state = 'active') AS active_metrics, count(*) FILTER (WHERE state = 'disabled') AS disabled_metrics,
    count(*) FILTER (WHERE state = 'dark') AS dark_metrics FROM mat GROUP BY kind, slug, lens),
elz AS (SELECT *, CASE WHEN active_metrics + disabled_metrics = 0 THEN 'dark' WHEN active_metrics > 0 THEN 'active' ELSE 'disabled' END AS lens_state FROM els)"""


@register("registry_entities", f"{_REGISTRY} SELECT kind, slug, substr(sha256(kind || ':' || slug), 1, 32) AS id FROM ent")
def registry_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.entity_registry(registry.entities(fixtures.spans_from_events(spark, sf_dir)))


@register("registry_bindings", f"{_REGISTRY} SELECT * FROM bind")
def registry_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.bindings(fixtures.spans_from_events(spark, sf_dir))


@register("registry_observations", f"{_REGISTRY} SELECT kind AS level, slug, span_type, sample_count FROM obs")
def registry_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In two batches, merged."""
    spans = fixtures.spans_from_events(spark, sf_dir)
    late = F.col("recorded_at") >= F.lit("2024-01-15").cast("timestamp")
    merged = registry.merge_observations(registry.observations(spans.where(~late)), registry.observations(spans.where(late)))
    return merged.select("level", "slug", "span_type", "sample_count")


@register("registry_thresholds", f"{_REGISTRY} SELECT category, metric_name, scope, solution_id, endpoint, workflow_id, agent_id, component_id, is_active FROM thr")
def registry_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registry(spark, sf_dir)["thresholds"].select("category", "metric_name", "scope", *schemas.PATH, "is_active")


@register("registry_replay", f"{_REGISTRY} SELECT (SELECT count(*) FROM ent) AS entities, (SELECT count(*) FROM bind) AS bindings, (SELECT count(*) FROM thr) AS thresholds")
def registry_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch reconciled twice leaves the registry as it was."""
    spans, catalog = fixtures.spans_from_events(spark, sf_dir), declared.catalog(spark)
    twice = registry.reconcile(spans, catalog, registry.reconcile(spans, catalog))
    names = ("entities", "bindings", "thresholds")
    counts = [twice[name].agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name in names]
    return counts[0].union(counts[1]).union(counts[2]).agg(*(F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names))


@register("active_toggles", f"{_REGISTRY} SELECT scope, solution_id, coalesce(endpoint, '') AS endpoint, coalesce(workflow_id, '') AS workflow_id, coalesce(agent_id, '') AS agent_id, coalesce(component_id, '') AS component_id, metric_name AS metric FROM thr WHERE is_active AND category = 'performance'")
def active_toggles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.active_keys(_registry(spark, sf_dir)["thresholds"], "performance")


@register("toggles_by_surrogate", f"{_REGISTRY} SELECT scope, solution_id, coalesce(endpoint, '') AS endpoint, coalesce(workflow_id, '') AS workflow_id, coalesce(agent_id, '') AS agent_id, coalesce(component_id, '') AS component_id, metric_name AS metric FROM thr WHERE is_active AND category = 'cost'")
def toggles_by_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toggles of thresholds that hold ids, through joins with the five registries."""
    state = _registry(spark, sf_dir)
    keyed = state["thresholds"].select("*", *(F.when(F.col(name).isNotNull(), registry.entity_id(F.lit(kind), F.col(name))).alias(f"{kind}_fk") for kind, name in registry.KINDS.items())).drop(*schemas.PATH)
    of = lambda kind: state["entities"].where(F.col("kind") == kind)
    return gate.load_toggles(keyed, of("solution"), of("endpoint"), of("workflow"), of("agent"), of("component"), "cost")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _registry(spark, sf_dir)
    return coverage.matrix(state["entities"], declared.catalog(spark), state["observations"], state["thresholds"])


@register("coverage_matrix", f"{_REGISTRY} SELECT * FROM mat")
def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).drop("id")


_PCT = "round(100.0 * {a} / nullif({a} + {d}, 0), 1)"


@register("coverage_entity_lens_summary", f"{_REGISTRY} SELECT *, CAST({_PCT.format(a='active_metrics', d='disabled_metrics')} AS DOUBLE) AS score_pct FROM elz")
def coverage_entity_lens_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.entity_lens_summary(_cells(spark, sf_dir))


@register("coverage_entity_summary", f"""{_REGISTRY}, es AS (SELECT kind, slug, CAST(sum(total_metrics) AS BIGINT) AS total_metrics, CAST(sum(active_metrics) AS BIGINT) AS active_metrics, CAST(sum(disabled_metrics) AS BIGINT) AS disabled_metrics,
  CAST(sum(dark_metrics) AS BIGINT) AS dark_metrics, count(*) AS total_lenses, count(*) FILTER (WHERE lens_state = 'active') AS active_lenses, count(*) FILTER (WHERE lens_state = 'disabled') AS disabled_lenses, count(*) FILTER (WHERE lens_state = 'dark') AS dark_lenses FROM elz GROUP BY kind, slug)
SELECT *, active_lenses + disabled_lenses AS applicable_lenses, CAST({_PCT.format(a='active_metrics', d='disabled_metrics')} AS DOUBLE) AS metric_coverage_pct, CAST({_PCT.format(a='active_lenses', d='disabled_lenses')} AS DOUBLE) AS lens_coverage_pct FROM es""")
def coverage_entity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.entity_summary(_cells(spark, sf_dir))


_CELLS = "count(*) AS total_cells, count(*) FILTER (WHERE state = 'active') AS active_cells, count(*) FILTER (WHERE state = 'disabled') AS disabled_cells, count(*) FILTER (WHERE state = 'dark') AS dark_cells, count(DISTINCT kind || '/' || slug) AS {n}"


@register("coverage_fleet_lens_summary", f"{_REGISTRY}, f AS (SELECT lens, {_CELLS.format(n='entities')} FROM mat GROUP BY lens) SELECT *, CAST({_PCT.format(a='active_cells', d='disabled_cells')} AS DOUBLE) AS score_pct FROM f")
def coverage_fleet_lens_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.fleet_lens_summary(_cells(spark, sf_dir))


@register("coverage_fleet_summary", f"{_REGISTRY}, f AS (SELECT {_CELLS.format(n='total_entities')} FROM mat) SELECT *, CAST({_PCT.format(a='active_cells', d='disabled_cells')} AS DOUBLE) AS overall_pct FROM f")
def coverage_fleet_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.fleet_summary(_cells(spark, sf_dir))


_MECHANICAL = ("format_correctness", "schema_conformance", "tool_call_validity", "data_completeness", "data_accuracy", "constraint_satisfaction")


@register("quality_mechanical", f"""{SPANS}
SELECT span_id, scope, 'tool_call_validity' AS metric, CAST(CASE WHEN ok_md AND k % 3 > 0 AND (k % 5 > 0 OR span_status <> 'ok') THEN 1 ELSE 0 END AS DOUBLE) AS value FROM u WHERE {_IN("tool_call")}
UNION ALL SELECT span_id, scope, 'data_completeness', CAST(CASE WHEN k % 2 = 0 THEN 1 ELSE 0.75 END AS DOUBLE) FROM u WHERE ok_md AND {_IN("validation")}
UNION ALL SELECT span_id, scope, 'data_accuracy', CAST(1 - (k % 3) / 4.0 AS DOUBLE) FROM u WHERE ok_md AND k % 4 = 2 AND {_IN("validation")}
UNION ALL SELECT span_id, scope, 'constraint_satisfaction', CAST(CASE WHEN k % 4 IN (1, 3) AND length('{{"a": ' || k || '}}') <= 9 THEN 1 ELSE 0 END AS DOUBLE) FROM u WHERE ok_md AND k % 5 = 0 AND {_IN("validation", "skill_exec")}
UNION ALL SELECT span_id, scope, 'format_correctness', CAST(1 AS DOUBLE) FROM u WHERE ok_md AND ({_IN("model_call", "validation")} OR ({_IN("tool_call")} AND k % 5 > 0))
UNION ALL SELECT span_id, scope, 'schema_conformance', CAST(k % 2 AS DOUBLE) FROM u WHERE ok_md AND {_IN("validation")}
UNION ALL SELECT span_id, scope, 'data_completeness', CAST(round(least(1.0, k / 100.0), 4) AS DOUBLE) FROM u WHERE ok_md AND {_IN("skill_exec")}""")
def quality_mechanical(spark: SparkSession, sf_dir: str) -> DataFrame:
    context = quality.with_mechanical(compiler.spans_of_lens(fixtures.spans_from_events(spark, sf_dir), "quality"))
    rows = compiler.emit(context, [spec for spec in declared.of_lens("quality") if spec.metric in _MECHANICAL])
    return rows.select("span_id", "scope", "metric", "value")


_TURNS = """WITH a AS (SELECT c.conv_id, c.turn, c.text, (SELECT max(p.turn) FROM conversations p WHERE p.conv_id = c.conv_id AND p.role = 'user' AND p.turn < c.turn) AS asked,
  (SELECT count(*) FROM conversations p WHERE p.conv_id = c.conv_id AND p.role = 'user') AS n_users FROM conversations c WHERE c.role = 'assistant')"""


class _LengthScorer(quality.Scorer):
    """Scores that SQL can repeat."""

    def generation(self, jobs):
        return [{name: len(output) % modulus / modulus for name, modulus in (("faithfulness", 101), ("coherence", 89), ("completeness", 83))} | {"meta": {"out_sents": 1}} for _, output in jobs]

    def retrieval(self, jobs):
        return [{"context_relevance": len(query) % 97 / 97, "chunk_utilization": 1 / len(chunks) if answer else None, "meta": {"chunks": len(chunks)}} for query, chunks, answer in jobs]


@register("quality_semantic", f"""{_TURNS}
SELECT 'call-' || conv_id || '-' || turn AS span_id, m.metric, CAST((length(text) % m.modulus) / CAST(m.modulus AS DOUBLE) AS DOUBLE) AS value FROM a, (VALUES ('faithfulness', 101), ('coherence', 89), ('completeness', 83)) AS m(metric, modulus) WHERE trim(text) <> ''
UNION ALL SELECT 'find-' || conv_id || '-' || turn, 'context_relevance', (SELECT length(q.text) % 97 FROM conversations q WHERE q.conv_id = a.conv_id AND q.turn = a.asked) / CAST(97 AS DOUBLE) FROM a WHERE asked IS NOT NULL AND n_users > 1
UNION ALL SELECT 'find-' || conv_id || '-' || turn, 'chunk_utilization', 1 / CAST(n_users - 1 AS DOUBLE) FROM a WHERE asked IS NOT NULL AND n_users > 1""")
def quality_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a scorer whose values follow from the texts' lengths: which spans get which semantic metric, and whose."""
    context = quality.with_semantic(fixtures.spans_from_conversations(spark, sf_dir), _LengthScorer())
    rows = compiler.emit(context, [spec for spec in declared.of_lens("quality") if spec.metric not in _MECHANICAL])
    return rows.select("span_id", "metric", "value")


@register("answers_by_trace", "SELECT 'conv-' || conv_id AS trace_id, trim(string_agg(text, chr(10) ORDER BY turn)) AS answer FROM conversations WHERE role = 'assistant' AND trim(text) <> '' GROUP BY conv_id")
def answers_by_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.answers_by_trace(fixtures.spans_from_conversations(spark, sf_dir))


@register("split_sentences", r"""SELECT doc_id, array_to_string(list_filter([trim(p) FOR p IN regexp_split_to_array(regexp_replace(text, '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(10), 'g'), '\n+')], lambda p: length(p) >= 3)[1:10], chr(10)) AS sentences FROM documents""")
def split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined by line ends, which no sentence holds."""
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", F.array_join(quality.split_sentences("text"), "\n").alias("sentences"))


_STUB = safety.KeywordClassifier({"ignore": 0.4, "override": 0.9}, {"idiot": 0.9, "moron": 0.9, "scum": 0.9, "trash": 0.5})


@register("safety_documents")
def safety_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The safety lens over documents, with the keyword classifier."""
    context = safety.with_safety(fixtures.spans_from_documents(spark, sf_dir), classifier=_STUB)
    return compiler.emit(context, declared.of_lens("safety")).select("span_id", "metric", "value", "metric_meta")


@register("safety_harmful", r"""SELECT 'doc-' || doc_id AS span_id, CAST(CASE WHEN regexp_matches(text, '(?i)\b(idiot|moron|scum)\b') THEN 1 ELSE 0 END AS DOUBLE) AS value FROM documents""")
def safety_harmful(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = safety.classify(texts, _STUB)
    return found.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("span_id"), F.when(F.col("harmful_score") >= safety.HARMFUL_THRESHOLD, 1.0).otherwise(0.0).alias("value"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"), ((F.col("doc_id") * 7919 % 997 + F.col("toxic") * 300) / 1300.0).alias("score"))
    return rows


_JUDGED = "WITH j AS (SELECT doc_id, toxic AS label, (doc_id * 7919 % 997 + toxic * 300) / 1300.0 AS score FROM labels)"


@register("eval_at_threshold", f"""{_JUDGED}, c AS (SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score >= 0.5 AND label <> 1) AS fp,
  count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score < 0.5 AND label <> 1) AS tn FROM j)
SELECT *, round(CAST(tp AS DOUBLE) / (tp + fp), 9) AS precision, round(CAST(tp AS DOUBLE) / (tp + fn), 9) AS recall, round(2.0 * tp / (2 * tp + fp + fn), 9) AS f1 FROM c""")
def eval_at_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.at_threshold(_judged(spark, sf_dir), 0.5)
    return found.select("tp", "fp", "fn", "tn", *(F.round(name, 9).alias(name) for name in ("precision", "recall", "f1")))


@register("eval_auroc", f"{_JUDGED} SELECT round(sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END) / count(*), 9) AS auroc FROM j p, j n WHERE p.label = 1 AND n.label <> 1")
def eval_auroc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.auroc(_judged(spark, sf_dir)).select(F.round("auroc", 9).alias("auroc"))


@register("eval_auprc", f"""{_JUDGED}, s AS (SELECT score, count(*) FILTER (WHERE label = 1) AS good, count(*) AS n FROM j GROUP BY score),
c AS (SELECT good, CAST(sum(good) OVER (ORDER BY score DESC) AS DOUBLE) AS tp, CAST(sum(n) OVER (ORDER BY score DESC) AS DOUBLE) AS seen FROM s)
SELECT round(sum(good * tp / seen) / CAST(sum(good) AS DOUBLE), 9) AS auprc FROM c""")
def eval_auprc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.auprc(_judged(spark, sf_dir)).select(F.round("auprc", 9).alias("auprc"))


@register("eval_best_threshold", f"""{_JUDGED}, g AS (SELECT unnest(range(0, 101)) AS step), s AS (SELECT step, sum(CASE WHEN floor(score * 100 + 1e-9) >= step AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN floor(score * 100 + 1e-9) >= step AND label <> 1 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN floor(score * 100 + 1e-9) < step AND label = 1 THEN 1 ELSE 0 END) AS fn FROM g, j GROUP BY step)
SELECT step / 100.0 AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, round(2.0 * tp / (2 * tp + fp + fn), 9) AS f1 FROM s ORDER BY 2.0 * tp / (2 * tp + fp + fn) DESC, step LIMIT 1""")
def eval_best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.best_threshold(_judged(spark, sf_dir))
    return found.select("threshold", "tp", "fp", "fn", F.round("f1", 9).alias("f1"))


@register("eval_spearman", "WITH r AS (SELECT rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS a, rank() OVER (ORDER BY doc_id) AS b FROM documents) SELECT round(corr(a, b), 9) AS spearman FROM r")
def eval_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.spearman(fixtures.table(spark, sf_dir, "documents"), "n_chars", "doc_id").select(F.round("spearman", 9).alias("spearman"))


def _one(name: str, source: str) -> Query:
    return lambda spark, sf_dir: QUERIES[source](spark, sf_dir).where(F.col("metric") == name)


for _source, _names in (("quality_mechanical", _MECHANICAL), ("quality_semantic", ("faithfulness", "coherence", "completeness", "context_relevance", "chunk_utilization")), ("safety_documents", ("pii_detected", "prompt_injection_detected", "toxicity_detected"))):
    for _name in _names:
        QUERIES[f"metric_{_name}"] = _one(_name, _source)
        if _source in ORACLE_SQL:
            ORACLE_SQL[f"metric_{_name}"] = f"SELECT * FROM ({ORACLE_SQL[_source]}) AS q WHERE metric = '{_name}'"


@register("verify_catalog", f"{_REGISTRY} SELECT lens, count(DISTINCT metric_name) AS n FROM off GROUP BY lens")
def verify_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared.catalog(spark).groupBy("lens").agg(F.count("*").alias("n"))


@register("verify_thresholds", f"{_REGISTRY} SELECT category, scope, count(*) AS n, count(*) FILTER (WHERE is_active) AS n_active FROM thr GROUP BY category, scope")
def verify_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registry(spark, sf_dir)["thresholds"].groupBy("category", "scope").agg(F.count("*").alias("n"), F.count_if("is_active").alias("n_active"))


@register("verify_states", f"{_REGISTRY} SELECT state, count(*) AS n FROM mat GROUP BY state")
def verify_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).groupBy("state").agg(F.count("*").alias("n"))


_SILENT = [(spec.metric, *METRIC_SQL[spec.metric]) for spec in declared.of_lens("performance") if spec.per_span]


@register("silent_metrics", f"""{SPANS}, m AS ({" UNION ALL ".join(f"SELECT '{name}' AS metric, count(*) FILTER (WHERE ({applies.split(' AND ')[0]}) AND NOT ({applies})) AS skipped FROM u" for name, applies, _ in _SILENT)})
SELECT metric, skipped FROM m ORDER BY skipped DESC, metric LIMIT 10""")
def silent_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten metrics of the performance lens that most often apply to a span but have no value there."""
    context = compiler.with_performance(fixtures.spans_from_events(spark, sf_dir))
    return compiler.skipped(context, declared.of_lens("performance")).limit(10)
