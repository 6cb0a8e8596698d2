"""The safety lens: personal data, prompt injection and harmful content of model calls.

Distinct texts are analysed once, in Arrow batches, and joined back by the hash
of the text; spans that no toggle needs are dropped by the gate beforehand.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import arrow, metadata
from spanloom.operators import gate, risk
from spanloom.operators.entities import Backend, Policy
from spanloom.plans import compiler

INJECTION_THRESHOLD, HARMFUL_THRESHOLD = 0.50, 0.83
METRICS = ("pii_detected", "prompt_injection_detected", "toxicity_detected")


class TextClassifier:
    """scores(texts) gives (prompt injection, harmful content) of each text, from 0 to 1."""

    def scores(self, texts: Sequence[str]) -> list[tuple[float, float]]:
        raise NotImplementedError


@dataclass(frozen=True)
class KeywordClassifier(TextClassifier):
    """The highest weight of the listed words that a text has: deterministic, for tests and as a floor."""

    injection: Mapping[str, float]
    harmful: Mapping[str, float]

    def scores(self, texts: Sequence[str]) -> list[tuple[float, float]]:
        best = lambda text, words: max((weight for word, weight in words.items() if re.search(rf"\b{re.escape(word)}\b", text, re.IGNORECASE)), default=0.0)
        return [(best(text, self.injection), best(text, self.harmful)) for text in texts]


def from_logits(labels: Sequence[str], logits, wanted: Sequence[str]) -> float:
    """The highest softmax probability among labels that contain one of the wanted words."""
    import numpy as np

    values = np.asarray(logits, float)
    p = np.exp(values - values.max())
    p /= p.sum()
    return max((float(p[i]) for i, label in enumerate(labels) if any(word in label.lower() for word in wanted)), default=0.0)


#: Labels of prompt-injection and of moderation models that count: fixed values.
INJECTION_LABELS, HARMFUL_LABELS = ("inject", "attack", "unsafe", "label_1"), ("toxic", "spam")


def classify_text(text: str, classifier: TextClassifier, injection_threshold: float = INJECTION_THRESHOLD, harmful_threshold: float = HARMFUL_THRESHOLD) -> dict:
    """labels, scores and latency_ms of one text; a blank one is an error."""
    if not isinstance(text, str) or not text.strip():
        raise ValueError("text must not be blank")
    began = time.perf_counter()
    injection, harmful = classifier.scores([text])[0]
    labels = [name for name, score, least in (("prompt_injection", injection, injection_threshold), ("harmful_content", harmful, harmful_threshold)) if score >= least]
    return {"labels": labels, "scores": {"prompt_injection": round(injection, 4), "harmful_content": round(harmful, 4)}, "latency_ms": round((time.perf_counter() - began) * 1000, 2)}


def classify(texts: DataFrame, classifier: TextClassifier, text: str = "text") -> DataFrame:
    """Adds injection_score and harmful_score; a blank text scores 0."""
    kept = texts.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [value or "" for value in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            distinct = [value for value in dict.fromkeys(values) if value.strip()]
            known = dict(zip(distinct, classifier.scores(distinct))) if distinct else {}
            pairs = [known.get(value, (0.0, 0.0)) for value in values]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p for p, _ in pairs], pa.float64()), pa.array([h for _, h in pairs], pa.float64())], [*kept, "injection_score", "harmful_score"])

    from pyspark.sql import types as T

    return arrow.by_batches(texts, work, T.StructType([*texts.schema.fields, T.StructField("injection_score", T.DoubleType()), T.StructField("harmful_score", T.DoubleType())]))


def analyzed(texts: DataFrame, policy: Policy, backend: Backend | None, classifier: TextClassifier | None) -> DataFrame:
    """text_hash, pii, injection_score, harmful_score of distinct texts (text_hash, text)."""
    found = risk.analyze_texts(texts, policy, backend)
    if classifier is None:
        return found.select("text_hash", "pii", F.lit(0.0).alias("injection_score"), F.lit(0.0).alias("harmful_score"))
    return classify(found, classifier).select("text_hash", "pii", "injection_score", "harmful_score")


def _sum(a: str, b: str) -> Column:
    empty = F.create_map().cast("map<string,bigint>")
    return F.map_zip_with(F.coalesce(a, empty), F.coalesce(b, empty), lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def _where(a: Column, b: Column) -> Column:
    return F.when(a & b, "both").when(a, "input").when(b, "output")


def _or_null(value: Column, empty: Column) -> Column:
    return F.when(~empty, value)


def with_safety(spans: DataFrame, policy: Policy = Policy(), backend: Backend | None = None, classifier: TextClassifier | None = None, injection_threshold: float = INJECTION_THRESHOLD, harmful_threshold: float = HARMFUL_THRESHOLD, active: DataFrame | None = None) -> DataFrame:
    """Adds the safety lens's context: the three verdicts and their metadata.

    active: the toggles' keys (gate.KEY). Only texts of spans with an active
    safety metric are analysed; other spans stay, as if their texts were blank.
    """
    read = spans.withColumn("md", metadata.parsed("metadata"))
    hashed = lambda path: F.when(F.trim(metadata.text("md", path)) != "", F.sha2(metadata.text("md", path), 256))
    read = read.withColumns({"_in": hashed("input"), "_out": hashed("output")})
    if active is not None:
        read = gate.flagged(read, active.where(F.col("metric").isin(*METRICS)), compiler.scopes_of(), compiler.path_columns, "_wanted")
        read = read.withColumns({key: F.when(F.col("_wanted"), F.col(key)) for key in ("_in", "_out")}).drop("_wanted")
    of = lambda key, path: read.where(F.col(key).isNotNull()).select(F.col(key).alias("text_hash"), metadata.text("md", path).alias("text"))
    texts = of("_in", "input").union(of("_out", "output")).dropDuplicates(["text_hash"])
    found = analyzed(texts, policy, backend, classifier)
    side = lambda name: found.select(F.col("text_hash").alias(f"_{name}"), F.col("pii").alias(f"_pii_{name}"), F.col("injection_score").alias(f"_inj_{name}"), F.col("harmful_score").alias(f"_harm_{name}"))
    joined = read.join(side("in"), "_in", "left").join(side("out"), "_out", "left")
    none = F.lit(0)
    n = {s: F.coalesce(F.col(f"_pii_{s}.pii_count"), none) for s in ("in", "out")}
    raw = F.coalesce("_pii_in.raw_count", none) + F.coalesce("_pii_out.raw_count", none)
    count = n["in"] + n["out"]
    rank = lambda s: F.coalesce(F.array_position(F.array(*map(F.lit, risk.SEVERITIES)), F.col(f"_pii_{s}.severity")), F.lit(1))
    severity = F.element_at(F.array(*map(F.lit, risk.SEVERITIES)), F.greatest(rank("in"), rank("out")).cast("int"))
    located = lambda s, where: F.transform(F.coalesce(F.col(f"_pii_{s}.violations"), F.array()), lambda v: F.struct(v["rule"].alias("rule"), v["severity"].alias("severity"), F.lit(where).alias("location"), v["entity_types"].alias("entity_types")))
    violations = F.concat(located("in", "input"), located("out", "output"))
    types, raw_types = _sum("_pii_in.types", "_pii_out.types"), _sum("_pii_in.raw_types", "_pii_out.raw_types")
    pii = F.struct(
        count.alias("count"), severity.alias("severity"), _or_null(types, F.size(types) == 0).alias("types"), _where(n["in"] > 0, n["out"] > 0).alias("location"),
        _or_null(violations, F.size(violations) == 0).alias("violations"), F.when(raw != count, raw).alias("raw_count"), F.when((raw != count) & (F.size(raw_types) > 0), raw_types).alias("raw_types"),
    )
    injection = F.coalesce("_inj_in", F.lit(0.0))
    harm = {s: F.coalesce(F.col(f"_harm_{s}"), F.lit(0.0)) for s in ("in", "out")}
    harmful = F.greatest(harm["in"], harm["out"])
    ran = F.lit(classifier is not None)
    triggered = F.array_compact(F.array(F.when(injection >= injection_threshold, "prompt_injection"), F.when(harmful >= harmful_threshold, "moderation")))
    meta = lambda **values: F.to_json(F.struct(*(value.alias(name) for name, value in values.items())))
    flag = lambda test: F.when(test, 1.0).otherwise(0.0)
    return joined.withColumns({
        "pii_detected": flag(count > 0),
        "pii_meta": F.when((count > 0) | (raw > 0), F.to_json(pii)),
        "prompt_injection_detected": flag(injection >= injection_threshold),
        "prompt_injection_meta": meta(prompt_injection_score=F.round(injection, 4), pi_bert_ran=ran, triggered_models=triggered),
        "toxicity_detected": flag(harmful >= harmful_threshold),
        "toxicity_meta": meta(harmful_content_score=F.round(harmful, 4), moderation_bert_ran=ran, triggered_models=triggered, moderation_location=_where(harm["in"] > 0, harm["out"] > 0)),
    }).drop("_in", "_out", "_pii_in", "_pii_out", "_inj_in", "_inj_out", "_harm_in", "_harm_out")
