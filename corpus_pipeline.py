"""The corpus pipeline: five stages over ``documents``, each of which works on all that the one before it kept.

Between stages the documents are written as Parquet to the shared folder and
read again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import common, decontamination, neardup, pieces, secrets, toxicity


def _measured(docs: DataFrame) -> DataFrame:
    """docs with n_chars, where there is such a column, as the text is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels that op7_toxicity learns from."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"), common.remainder("doc_id", 4) != 2)
    score, predicted = common.fresh_name(docs, "score"), common.fresh_name(docs, "predicted")
    scored = toxicity.score(docs, model, names=(score, predicted))
    return scored.where(F.col(predicted) == 0).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return neardup.deduplicate(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; others lose the words that occur in a benchmark window, until none is left."""
    return _measured(decontamination.decontaminate(docs, common.table(spark, sf_dir, "benchmark")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mask."""
    return _measured(secrets.redact(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of the SentencePiece model."""
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_text),
    ("secrets", mask_secrets),
    ("sentencepiece", encode),
]

#: No SQL can express the trained, hashed and tokenised stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir. A stage's documents are removed once the next stage's are written."""
    folder, before = common.scratch(spark, "pipeline"), None
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            common.remove(spark, before)
        before = f"{folder}/{name}"
    return docs
