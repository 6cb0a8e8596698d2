"""Public evaluation sets, as rows of texts and gold labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def question_answers(spark: SparkSession, path: str) -> DataFrame:
    """premise, hypothesis, label from JSON lines of knowledge, question, right_answer, hallucinated_answer: two rows each, 1 for the right one."""
    rows = spark.read.json(path, schema="knowledge string, question string, right_answer string, hallucinated_answer string")
    pairs = F.array(F.struct(F.col("right_answer").alias("hypothesis"), F.lit(1).alias("label")), F.struct(F.col("hallucinated_answer").alias("hypothesis"), F.lit(0).alias("label")))
    return rows.select(F.concat_ws(" ", "knowledge", "question").alias("premise"), F.explode(pairs).alias("p")).select("premise", "p.*")


def passages(spark: SparkSession, path: str) -> DataFrame:
    """query, passage, label from Parquet of query and passages (passage_text and is_selected, two arrays)."""
    rows = spark.read.parquet(path)
    return rows.select("query", F.explode(F.arrays_zip(F.col("passages.passage_text").alias("passage"), F.col("passages.is_selected").alias("label"))).alias("p")).select("query", F.col("p.passage").alias("passage"), F.col("p.label").cast("int").alias("label"))


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """text, summary, coherence, relevance from Parquet of a text and arrays of summaries and their ratings."""
    rows = spark.read.parquet(path)
    return rows.select("text", F.explode(F.arrays_zip(F.col("machine_summaries").alias("summary"), "coherence", "relevance")).alias("s")).select("text", "s.*")


def balanced(rows: DataFrame, each: int, label: str = "label", seed: int = 0) -> DataFrame:
    """The same number of rows of each label at most, chosen by a hash of the row: a sample for evaluation."""
    order = F.xxhash64(F.lit(seed), *(F.col(name) for name in rows.columns))
    return rows.withColumn("_at", F.row_number().over(Window.partitionBy(label).orderBy(order))).where(F.col("_at") <= each).drop("_at")
