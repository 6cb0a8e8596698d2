"""Spans derived from plain event tables, for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schemas

#: Price list of the derived components: fixed values.
PRICES = {
    "model_gpt4o": {"component_type": "model", "pricing": {"input_per_1k": 0.005, "output_per_1k": 0.015, "cached_per_1k": 0.0025}},
    "model_claude": {"component_type": "model", "pricing": {"input_per_1k": 0.003, "output_per_1k": 0.015, "cached_per_1k": 0.0003}},
    "model_embed": {"component_type": "model", "pricing": {"input_per_1k": 0.00002}},
    "tool_websearch": {"component_type": "tool", "pricing": {"per_call": 0.005}},
    "kb_product_docs": {"component_type": "knowledge_base", "pricing": {"per_query": 0.0001}},
}
_TYPES = ("solution", "workflow", "agent", "model_call", "tool_call", "embedding", "retrieval", "validation", "skill_exec")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spans_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span for each event; every 13th event has invalid metadata, every 17th the null marker."""
    k, user, event = F.col("k"), F.col("user_id"), F.col("event_id")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("started_at"), F.get_json_object("props", "$.k").cast("int").alias("k"), F.round(F.col("value") * 1000).cast("bigint").alias("micros"))
    kind = F.element_at(F.array(*(F.lit(name) for name in _TYPES)), (k % 9 + 1).cast("int"))
    rows = rows.withColumn("span_type", kind).withColumn("ended_at", F.timestamp_micros(F.unix_micros("started_at") + F.col("micros")))
    stamp = lambda shift: F.date_format(F.timestamp_micros(F.unix_micros("started_at") + shift * 1000), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    data = F.col("span_type").isin("validation", "skill_exec")  # whose metadata holds a record, errors and constraints
    usage = F.struct((100 + k).alias("input_tokens"), (10 * k).alias("output_tokens"), k.alias("cached_tokens"), (k % 7).alias("reasoning_tokens"))
    good = F.to_json(F.struct(
        usage.alias("usage"), (k % 4).alias("retry_count"), (k * 5).alias("retry_delay_ms"), (k % 2 == 0).alias("rate_limit_hit"), k.alias("rate_limit_wait_ms"),
        (50 + k).alias("embedding_tokens"), (k % 5).alias("search_units"), k.alias("records_processed"), F.lit(100).alias("batch_size"),
        stamp(k).alias("first_token_at"), stamp(-2 * k).alias("enqueued_at"), stamp(-k).alias("scheduled_at"),
        F.when(k % 3 > 0, F.lit("search")).otherwise(F.lit(" ")).alias("tool"), F.struct(k.alias("q")).alias("request"),
        F.when(k % 5 > 0, F.to_json(F.struct(k.alias("r")))).alias("response"),
        F.when(data & (k % 4 == 2), F.to_json(F.struct(k.alias("a"), F.slice(F.array(F.lit("late"), F.lit("wrong")), F.lit(1), k % 3).alias("errors"))))
        .when(k % 4 > 0, F.concat(F.lit('{"a": '), k.cast("string"), F.lit("}"))).otherwise(F.lit("plain words")).alias("output"),
        F.when(data, F.to_json(F.struct(k.alias("a"), F.when(k % 2 == 0, "x").otherwise("").alias("b"), F.lit("y").alias("c"), F.lit("z").alias("d")))).alias("input"),
        F.when(data & (k % 5 == 0), F.struct(F.lit(9).alias("max_chars"), F.lit("plain").alias("not_contains"), F.lit(None).cast("string").alias("tone")))
        .when(data & (k % 5 == 1), F.struct(F.lit(None).cast("int").alias("max_chars"), F.lit(None).cast("string").alias("not_contains"), F.lit("kind").alias("tone"))).alias("constraints"),
        (k % 2 == 1).alias("valid"),
    ))
    deep = ~F.col("span_type").isin("solution", "workflow", "agent")
    level = F.when(deep, F.lit("component")).otherwise(F.col("span_type"))
    model = F.when(event % 2 == 0, "model_gpt4o").otherwise("model_claude")
    component = (
        F.when(F.col("span_type") == "model_call", model).when(F.col("span_type") == "embedding", "model_embed").when(F.col("span_type") == "tool_call", "tool_websearch")
        .when(F.col("span_type") == "retrieval", "kb_product_docs").when(F.col("span_type") == "validation", "func_validate").when(F.col("span_type") == "skill_exec", "skill_ner").otherwise("")
    )
    text = lambda column: column.cast("string")
    values = {
        "trace_id": F.concat(F.lit("tr-"), text(user), F.lit("-"), F.date_format("started_at", "yyyy-MM-dd")),
        "span_id": F.concat(F.lit("ev-"), text(event)), "parent_span_id": F.lit(""), "correlation_id": F.lit(""), "session_id": F.concat(F.lit("u-"), text(user)),
        "span_type": F.col("span_type"), "span_name": F.col("event_type"),
        "span_status": F.when(F.col("event_type") != "error", "ok").when(k % 10 < 7, "error").otherwise("timeout"),
        "scope": level, "solution_id": F.concat(F.lit("sol_"), text(user % 2)),
        "endpoint": F.when(user % 5 == 0, "").otherwise(F.concat(F.lit("/v1/"), F.col("event_type"))),
        "workflow_id": F.when(F.col("span_type") == "solution", "").otherwise(F.concat(F.lit("wf_"), text(user % 3))),
        "agent_id": F.when(F.col("span_type").isin("solution", "workflow"), "").otherwise(F.concat(F.lit("agt_"), text(user % 8))),
        "component_id": component,
        "component_type": F.when(~deep, "").otherwise(F.element_at(F.split(component, "_"), 1)),
        "started_at": F.col("started_at"), "ended_at": F.col("ended_at"), "pipeline_stage": F.lit(""), "stage_order": F.lit(None), "entity_type": F.lit(""),
        "service": F.lit("svc"), "environment": F.when(user % 10 < 8, "prod").otherwise("staging"), "region": F.lit(""),
        "metadata": F.when(event % 13 == 0, F.lit("{not json")).when(event % 17 == 0, F.lit(r"\N")).otherwise(good),
        "recorded_at": F.date_trunc("millisecond", "ended_at"),
    }
    return rows.select(*(values[field.name].cast(field.dataType).alias(field.name) for field in schemas.RAW_SPANS))


def spans_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model call for each assistant turn, and a retrieval before it: its query is the last user turn, its chunks are the others."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    users = turns.where("role = 'user'").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("users"))  # a conversation's turns
    rows = turns.where("role = 'assistant'").join(users, "conv_id", "left")
    before = F.filter("users", lambda u: u["turn"] < F.col("turn"))
    asked = F.when(F.size(before) > 0, F.element_at(before, -1))
    rows = rows.withColumn("asked", asked)
    others = F.transform(F.filter("users", lambda u: u["turn"] != F.col("asked.turn")), lambda u: F.struct(u["text"].alias("text")))
    at = F.timestamp_micros(F.lit(1704067200000000) + (F.col("conv_id") * 1000 + F.col("turn")) * 1000000)
    base = {field.name: F.lit("") if field.dataType.simpleString() == "string" else F.lit(None).cast(field.dataType) for field in schemas.RAW_SPANS}
    shared = base | {
        "trace_id": F.concat(F.lit("conv-"), F.col("conv_id").cast("string")), "span_status": F.lit("ok"), "scope": F.lit("component"), "solution_id": F.lit("sol_0"),
        "component_type": F.lit("model"), "started_at": at, "ended_at": F.timestamp_micros(F.unix_micros(at) + 250000), "environment": F.lit("prod"), "recorded_at": F.timestamp_micros(F.unix_micros(at) + 250000),
    }
    name = lambda prefix: F.concat(F.lit(prefix), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    call = shared | {"span_id": name("call-"), "span_type": F.lit("model_call"), "component_id": F.lit("model_gpt4o"), "metadata": F.to_json(F.struct(F.col("asked.text").alias("input"), F.col("text").alias("output")))}
    find = shared | {"span_id": name("find-"), "span_type": F.lit("retrieval"), "component_id": F.lit("kb_product_docs"), "metadata": F.to_json(F.struct(F.col("asked.text").alias("query"), others.alias("chunks")))}
    pick = lambda values: rows.select(*(values[field.name].cast(field.dataType).alias(field.name) for field in schemas.RAW_SPANS))
    return pick(call).union(pick(find))


def spans_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model call for each document, whose text is the input."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    at = F.timestamp_micros(F.lit(1704067200000000) + F.col("doc_id") * 1000)
    base = {field.name: F.lit("") if field.dataType.simpleString() == "string" else F.lit(None).cast(field.dataType) for field in schemas.RAW_SPANS}
    values = base | {
        "trace_id": F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), "span_id": F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), "span_type": F.lit("model_call"), "span_status": F.lit("ok"),
        "scope": F.lit("component"), "solution_id": F.lit("sol_0"), "component_id": F.lit("model_gpt4o"), "component_type": F.lit("model"), "started_at": at, "ended_at": at, "environment": F.lit("prod"), "recorded_at": at,
        "metadata": F.to_json(F.struct(F.col("text").alias("input"))),
    }
    return rows.select(*(values[field.name].cast(field.dataType).alias(field.name) for field in schemas.RAW_SPANS))
