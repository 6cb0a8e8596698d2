"""Quality of outputs: mechanical checks as Columns, semantic scores through a scorer that is given."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions import arrow, metadata
from spanloom.operators import gate
from spanloom.plans import compiler

SCHEMA_KEYS = ("expected_schema", "response_schema", "schema")
#: Constraints that can be checked.
KNOWN = ("max_chars", "min_chars", "max_words", "min_words", "contains", "not_contains", "format")


def _at(path: str) -> Column:
    return F.try_variant_get("md", f"$.{path}", "variant")


def _raw(path: str) -> Column:
    return metadata.text("md", path)


def _parsed(raw: Column) -> Column:
    """What the text holds if it is JSON."""
    return F.try_parse_json(raw)


def _empty(path: str) -> Column:
    """Missing, null, an empty text, list or object."""
    kind = metadata.kind(_at(path))
    hollow = kind.isin("array", "object") & _raw(path).isin("[]", "{}")
    return kind.isNull() | (kind == "void") | hollow | ((kind == "string") & (_raw(path) == ""))


def _word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def format_correctness() -> Column:
    """1 if the payload parses as its declared or apparent format; plain text has none to violate.

    A text that fails to parse stays a text and passes; only the JSON text null
    fails.
    """
    path = lambda: F.col("span_type") == "tool_call"
    kind = F.when(path(), metadata.kind(_at("response"))).otherwise(metadata.kind(_at("output")))
    raw = F.trim(F.when(path(), _raw("response")).otherwise(_raw("output")))
    empty = F.when(path(), _empty("response")).otherwise(_empty("output"))
    declared = F.lower(F.coalesce(F.nullif(_raw("output_format"), F.lit("")), _raw("format"), F.lit("")))
    asked = (declared == "json") | ((declared == "") & (raw.startswith("{") | raw.startswith("[")))
    return F.when(empty, F.lit(None).cast("double")).when(kind.isin("object", "array"), 1.0).when(asked & (raw == "null"), 0.0).otherwise(1.0)


def schema_conformance() -> Column:
    """Validation spans: their verdict. Others: whether the output has all keys that the declared schema requires."""
    valid = F.when(_raw("valid").isNull(), F.lit(None).cast("double")).when(_raw("valid").isin("true", "True", "1", "1.0"), 1.0).otherwise(0.0)
    present = [F.when(~_raw(key).isin("", "{}", "[]", "false", "0"), _raw(key)) for key in SCHEMA_KEYS]
    schema, output = F.coalesce(*present), _raw("output")
    listed = F.from_json(F.get_json_object(schema, "$.required"), "array<string>")
    keys = F.json_object_keys(F.coalesce(F.when(F.size(F.json_object_keys(F.get_json_object(schema, "$.properties"))) > 0, F.get_json_object(schema, "$.properties")), schema))
    required = F.when(F.size(listed) > 0, listed).otherwise(keys)
    whole = metadata.kind(_parsed(output)) == "object"
    met = F.size(F.array_except(required, F.json_object_keys(output))) == 0
    checked = F.when(metadata.kind(_parsed(schema)) != "object", F.lit(None).cast("double")).when(schema.isNull(), F.lit(None).cast("double")).when(~F.coalesce(whole, F.lit(False)), 0.0).when(met, 1.0).otherwise(0.0)
    return F.when(F.col("span_type") == "validation", valid).otherwise(checked)


def tool_failures() -> Column:
    """What is wrong with a tool call: missing_tool_name, malformed_request, missing_response."""
    named = (metadata.kind(_at("tool")) == "string") & (F.trim(_raw("tool")) != "")
    request = F.coalesce(metadata.kind(_parsed(_raw("request"))).isin("object", "array"), F.lit(False))
    answered = ~_empty("response") | F.coalesce(F.col("span_status").isin("error", "timeout"), F.lit(False))
    wrong = lambda good, name: F.when(~F.coalesce(good, F.lit(False)), F.lit(name))
    return F.array_compact(F.array(wrong(named, "missing_tool_name"), wrong(request, "malformed_request"), wrong(answered, "missing_response")))


def _record() -> Column:
    return F.when(metadata.kind(_parsed(_raw("input"))) == "object", _parsed(_raw("input")))


def data_completeness() -> Column:
    """Validation: the share of a record's fields that hold something. Skills: the share of a batch that was processed."""
    values = F.map_values(F.try_variant_get(_record(), "$", "map<string,variant>"))
    hollow = lambda v: metadata.kind(v).isNull() | (metadata.kind(v) == "void") | F.coalesce(F.to_json(v).isin('""', "[]", "{}"), F.lit(False))
    filled = F.size(F.filter(values, lambda v: ~hollow(v)))
    share = F.when(F.size(values) > 0, F.round(filled / F.size(values), 4))
    batch = F.nullif(metadata.number("md", "batch_size"), F.lit(0.0))
    done = F.round(F.least(F.lit(1.0), metadata.number("md", "records_processed") / batch), 4)
    return F.when(F.col("span_type") == "validation", share).otherwise(F.when(batch.isNotNull() & metadata.number("md", "records_processed").isNotNull(), done))


def _errors() -> Column:
    return F.get_json_object(_raw("output"), "$.errors")


def data_accuracy() -> Column:
    """1 less errors by field of the record, at least 0; null unless the output is an object with errors."""
    has = F.array_contains(F.json_object_keys(F.when(metadata.kind(_parsed(_raw("output"))) == "object", _raw("output"))), "errors")
    count = F.coalesce(F.json_array_length(_errors()), F.size(F.json_object_keys(_errors())), F.lit(0))
    fields = F.greatest(F.lit(1), F.coalesce(F.size(F.json_object_keys(F.to_json(_record()))), F.lit(1)))
    return F.when(F.coalesce(has, F.lit(False)), F.round(F.greatest(F.lit(0.0), 1.0 - F.greatest(count, F.lit(0)) / fields), 4))


def constraint_results() -> Column:
    """(key, ok) for every key of the constraints object; ok is null where it can't be checked. A non-text output counts as its JSON text."""
    raw = _raw("constraints")
    held = F.when(metadata.kind(_parsed(raw)) == "object", raw)
    text = F.coalesce(_raw("output"), F.lit(""))
    want = lambda key: F.try_variant_get(_parsed(held), f"$.{key}", "double")
    kind = lambda key: metadata.kind(F.try_variant_get(_parsed(held), f"$.{key}", "variant"))
    value = lambda key: F.try_variant_get(_parsed(held), f"$.{key}", "string")
    parts = lambda key: F.when(kind(key) == "array", F.from_json(value(key), "array<string>")).when(kind(key) == "string", F.array(value(key)))
    tests = {
        "max_chars": F.char_length(text) <= want("max_chars"),
        "min_chars": F.char_length(text) >= want("min_chars"),
        "max_words": _word_count(text) <= want("max_words"),
        "min_words": _word_count(text) >= want("min_words"),
        "contains": F.forall(parts("contains"), lambda s: F.contains(text, s)),
        "not_contains": ~F.exists(parts("not_contains"), lambda s: F.contains(text, s)),
        "format": F.when(F.lower(value("format")) == "json", F.trim(text) != "null"),
    }
    ok = lambda key: F.coalesce(*(F.when(key == name, test) for name, test in tests.items()))
    return F.transform(F.json_object_keys(held), lambda key: F.struct(key.alias("key"), ok(key).alias("ok")))


def with_mechanical(spans: DataFrame) -> DataFrame:
    """Adds md and the values and metadata of the six mechanical metrics."""
    read = spans.withColumn("md", metadata.parsed("metadata")).withColumns({"_failed": tool_failures(), "_constraints": constraint_results(), "accuracy_errors": _errors()})
    unchecked = F.transform(F.filter("_constraints", lambda c: c["ok"].isNull()), lambda c: c["key"])
    violated = F.transform(F.filter("_constraints", lambda c: ~c["ok"]), lambda c: c["key"])
    some = F.when(F.size("_constraints") > 0, F.col("_constraints"))
    all_unchecked = F.size(unchecked) == F.size("_constraints")
    none = lambda array: F.when(F.size(array) > 0, array)
    said = F.to_json(F.struct(none(violated).alias("violated"), none(unchecked).alias("unchecked")))
    listed = F.from_json("accuracy_errors", "array<string>")
    return read.withColumns({
        "format_correctness": format_correctness(),
        "schema_conformance": schema_conformance(),
        "tool_call_validity": F.when(F.size("_failed") > 0, 0.0).otherwise(1.0),
        "tool_meta": F.when(F.size("_failed") > 0, F.to_json(F.struct(F.col("_failed").alias("failed")))),
        "data_completeness": data_completeness(),
        "data_accuracy": data_accuracy(),
        "accuracy_meta": F.when(F.size(listed) > 0, F.to_json(F.struct(F.slice(listed, 1, 20).alias("errors")))),
        "constraint_satisfaction": F.when(some.isNull() | all_unchecked, F.lit(None).cast("double")).when(F.size(violated) > 0, 0.0).otherwise(1.0),
        "constraint_meta": F.when(some.isNotNull() & (said != "{}"), said),
    }).drop("_failed", "_constraints", "accuracy_errors")


def split_sentences(text: str | Column, most: int = 10, least_chars: int = 3) -> Column:
    """The first sentences of a text: cut after . ! ? and blanks or at line ends, trimmed, of a least length."""
    parts = F.transform(F.split(text, r"(?<=[.!?])\s+|\n+"), lambda s: F.trim(s))
    return F.slice(F.filter(parts, lambda s: F.char_length(s) >= least_chars), 1, most)


def sentences_of(text: str, most: int = 10, least_chars: int = 3) -> list[str]:
    """split_sentences in Python."""
    import re

    return [s for s in (part.strip() for part in re.split(r"(?<=[.!?])\s+|\n+", text)) if len(s) >= least_chars][:most]


def normalized_output(text: str, most_items: int = 20) -> str:
    """JSON as lines "key is value."; other text as it is."""
    try:
        value = json.loads(text)
    except (TypeError, ValueError):
        return text or ""
    if not isinstance(value, (dict, list)):
        return text

    def lines(node, key: str) -> Iterator[str]:
        if isinstance(node, dict):
            for name, one in node.items():
                yield from lines(one, f"{key} {name}".strip())
        elif isinstance(node, list):
            for one in node[:most_items]:
                yield from lines(one, key)
        elif node is not None:
            yield f"{key} is {node}." if key else f"{node}."

    return "\n".join(line.replace("_", " ") for line in lines(value, ""))


class Scorer:
    """Semantic scores of jobs; subclasses hold models. Scores are from 0 to 1 or None."""

    def generation(self, jobs: Sequence[tuple[str, str]]) -> list[dict]:
        """(input, output) to faithfulness, coherence, completeness, meta."""
        raise NotImplementedError

    def retrieval(self, jobs: Sequence[tuple[str, list[str], str | None]]) -> list[dict]:
        """(query, chunks, answer) to context_relevance, chunk_utilization, meta."""
        raise NotImplementedError


class StaticScorer(Scorer):
    """The same score for everything: a double for tests."""

    def __init__(self, value: float = 0.75) -> None:
        self.value = value

    def generation(self, jobs: Sequence[tuple[str, str]]) -> list[dict]:
        return [{"faithfulness": self.value, "coherence": self.value, "completeness": self.value, "meta": {"out_sents": 1}} for _ in jobs]

    def retrieval(self, jobs: Sequence[tuple[str, list[str], str | None]]) -> list[dict]:
        return [{"context_relevance": self.value, "chunk_utilization": self.value if answer else None, "meta": {"chunks": len(chunks)}} for _, chunks, answer in jobs]


class RecipeScorer(Scorer):
    """Scores from three models: nli(pairs) -> (entailment, contradiction) rows, embed(texts) -> matrix, relevance(pairs) -> logits."""

    def __init__(self, nli: Callable, embed: Callable, relevance: Callable, premise_chars: int = 2000, sentences: int = 10, least_chars: int = 3, used: float = 0.5) -> None:
        self.nli, self.embed, self.relevance = nli, embed, relevance
        self.premise_chars, self.sentences, self.least_chars, self.used = premise_chars, sentences, least_chars, used

    def _best(self, texts: list[str], others: list[str]) -> np.ndarray:
        """For each text its largest cosine to the others."""
        a, b = (np.asarray(self.embed(x), float) for x in (texts, others))
        a, b = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) for m in (a, b))
        return (a @ b.T).max(axis=1)

    def generation(self, jobs: Sequence[tuple[str, str]]) -> list[dict]:
        out = []
        for given, produced in jobs:
            own = sentences_of(normalized_output(produced), self.sentences, self.least_chars)
            asked = sentences_of(given or "", self.sentences, self.least_chars)
            row: dict = {"faithfulness": None, "coherence": None, "completeness": None, "meta": {"out_sents": len(own)}}
            if own and given:
                entailed = np.asarray(self.nli([(given[: self.premise_chars], s) for s in own]), float)[:, 0]
                row["faithfulness"] = float(entailed.mean())
                row["meta"]["min_entail"] = round(float(entailed.min()), 4)
            if len(own) >= 2:
                row["coherence"] = float(1 - np.asarray(self.nli(list(zip(own, own[1:]))), float)[:, 1].mean())
            if own and asked:
                row["completeness"] = float(np.clip(self._best(asked, own).mean(), 0, 1))
            out.append(row)
        return out

    def retrieval(self, jobs: Sequence[tuple[str, list[str], str | None]]) -> list[dict]:
        out = []
        for query, chunks, answer in jobs:
            row: dict = {"context_relevance": None, "chunk_utilization": None, "meta": {"chunks": len(chunks)}}
            if query and chunks:
                relevant = 1 / (1 + np.exp(-np.asarray(self.relevance([(query, c) for c in chunks]), float)))
                row["context_relevance"] = float(relevant.mean())
                row["meta"]["rel"] = [round(float(r), 4) for r in relevant]
            said = sentences_of(answer or "", self.sentences, self.least_chars)
            if chunks and said:
                used = self._best(chunks, said) >= self.used
                row["chunk_utilization"] = float(used.mean())
                row["meta"]["used"] = int(used.sum())
            out.append(row)
        return out


def answers_by_trace(spans: DataFrame) -> DataFrame:
    """trace_id, answer: the outputs of a trace's model calls, in order, joined by line ends."""
    rows = spans.where("span_type = 'model_call'").withColumn("md", metadata.parsed("metadata"))
    rows = rows.select("trace_id", F.struct("recorded_at", "span_id", metadata.text("md", "output").alias("output")).alias("o")).where(F.trim("o.output") != "")
    return rows.groupBy("trace_id").agg(F.trim(F.array_join(F.transform(F.array_sort(F.collect_list("o")), lambda o: o["output"]), "\n")).alias("answer"))


def _scored(jobs: DataFrame, columns: list[str], call: Callable[[list[tuple]], list[dict]], names: list[str], hashed: str) -> DataFrame:
    """Scores of distinct jobs: each is scored once, whatever the number of spans that have it."""
    distinct = jobs.select(hashed, *columns).dropDuplicates([hashed])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = call(list(zip(*(column.to_pylist() for column in batch.columns[1:])))) if batch.num_rows else []
            values = [pa.array([row[name] for row in rows], pa.float64()) for name in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), *values, pa.array([json.dumps(row["meta"], separators=(",", ":")) for row in rows], pa.string())], [hashed, *names, "meta"])

    schema = T.StructType([T.StructField(hashed, T.StringType()), *(T.StructField(name, T.DoubleType()) for name in names), T.StructField("meta", T.StringType())])
    return arrow.by_batches(distinct, work, schema)


GENERATION = ("faithfulness", "coherence", "completeness")
RETRIEVAL = ("context_relevance", "chunk_utilization")


def with_semantic(spans: DataFrame, scorer: Scorer, answers: DataFrame | None = None, active: DataFrame | None = None) -> DataFrame:
    """Adds md, the five semantic metrics and their metadata; answers: of whole traces, from answers_by_trace.

    active: the toggles' keys (gate.KEY). Only jobs of spans with an active
    metric of the job's kind are scored; other spans stay, without scores.
    """
    read = spans.withColumn("md", metadata.parsed("metadata"))
    if answers is None:
        answers = answers_by_trace(spans)
    model = F.col("span_type") == "model_call"
    read = read.join(answers, "trace_id", "left").withColumns({"_input": F.when(model, metadata.text("md", "input")), "_output": F.when(model, metadata.text("md", "output"))})
    chunks = F.transform(F.from_json(metadata.text("md", "chunks"), "array<struct<text:string>>"), lambda c: c["text"])
    read = read.withColumns({"_query": F.when(F.col("span_type") == "retrieval", metadata.text("md", "query")), "_chunks": F.filter(chunks, lambda c: F.trim(c) != "")})
    read = read.withColumn("_gen", F.when(F.trim("_output") != "", F.sha2(F.to_json(F.struct("_input", "_output")), 256)))
    read = read.withColumn("_ret", F.when((F.trim("_query") != "") & (F.size("_chunks") > 0), F.sha2(F.to_json(F.struct("_query", "_chunks", "answer")), 256)))
    if active is not None:
        for key, metrics in (("_gen", GENERATION), ("_ret", RETRIEVAL)):
            read = gate.flagged(read, active.where(F.col("metric").isin(*metrics)), compiler.scopes_of(), compiler.path_columns, "_wanted").withColumn(key, F.when(F.col("_wanted"), F.col(key))).drop("_wanted")
    made = _scored(read.where("_gen IS NOT NULL"), ["_input", "_output"], scorer.generation, list(GENERATION), "_gen").withColumnRenamed("meta", "generation_meta")
    found = _scored(read.where("_ret IS NOT NULL"), ["_query", "_chunks", "answer"], scorer.retrieval, list(RETRIEVAL), "_ret").withColumnRenamed("meta", "retrieval_meta")
    return read.join(made, "_gen", "left").join(found, "_ret", "left").drop("_input", "_output", "_query", "_chunks", "_gen", "_ret", "answer")
