"""Schemas of the fixed tables. Missing strings are empty, not null."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _TS, _D, _L = T.StringType(), T.TimestampType(), T.DoubleType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


PATH = ("solution_id", "endpoint", "workflow_id", "agent_id", "component_id")
SCOPES = ("solution", "endpoint", "workflow", "agent", "component")

RAW_SPANS = _struct(
    *((name, _S) for name in ("trace_id", "span_id", "parent_span_id", "correlation_id", "session_id", "span_type", "span_name", "span_status", "scope", *PATH, "component_type")),
    ("started_at", _TS), ("ended_at", _TS), ("pipeline_stage", _S), ("stage_order", T.ShortType()), ("entity_type", _S),
    ("service", _S), ("environment", _S), ("region", _S), ("metadata", _S), ("recorded_at", _TS),
)

DERIVED = _struct(
    ("span_id", _S), ("trace_id", _S), ("parent_span_id", _S), ("scope", _S), *((name, _S) for name in PATH), ("component_type", _S), ("environment", _S),
    ("ts", _TS), ("metric", _S), ("value", _D), ("confidence", T.FloatType()), ("metric_meta", _S), ("start_ts", _TS), ("end_ts", _TS),
)

#: What rows of partial states are grouped by, besides their minute.
ROLLUP_KEYS = ("scope", *PATH, "component_type", "environment", "metric")

THRESHOLDS = _struct(
    ("category", _S), ("metric_name", _S), ("scope", _S), ("time_window", _S), ("operator", _S), ("warning_value", _D), ("critical_value", _D),
    *((name, _S) for name in PATH), ("is_active", T.BooleanType()),
)

CATALOG = _struct(
    ("metric_name", _S), ("lens", _S), ("required_span_types", T.ArrayType(_S)), ("applicable_scopes", T.ArrayType(_S)), ("unit", _S), ("default_window", _S), ("default_operator", _S),
)
