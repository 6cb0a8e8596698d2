"""Spans from files and streams, and the small tables beside them."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom import schemas
from spanloom.functions import metadata

PRICING = "component_id string, component_type string, pricing map<string,double>"


def span_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw spans from CSV with a header; times with or without fractions, a missing string is empty."""
    text = T.StructType([T.StructField(field.name, T.StringType()) for field in schemas.RAW_SPANS])
    rows = spark.read.csv(path, header=True, schema=text, escape='"', multiLine=True, emptyValue="", nullValue="\u0000")
    return _typed(rows, schemas.RAW_SPANS)


def derived_csv(spark: SparkSession, path: str) -> DataFrame:
    """Derived metrics from CSV with a header."""
    text = T.StructType([T.StructField(field.name, T.StringType()) for field in schemas.DERIVED])
    return _typed(spark.read.csv(path, header=True, schema=text, escape='"', multiLine=True, emptyValue="", nullValue="\u0000"), schemas.DERIVED)


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    columns = []
    for field in schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = metadata.moment(column)
        elif isinstance(field.dataType, T.StringType):
            column = F.coalesce(column, F.lit(""))
        else:
            column = F.when(column.isin("", r"\N"), None).otherwise(column).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def since(spans: DataFrame, checkpoint: str | None, limit: int | None = None, span_types: Iterable[str] = (), slot: int | None = None, slots: int = 16) -> DataFrame:
    """The next spans after a checkpoint, by recording time: the batch twin of the stream."""
    if checkpoint is not None:
        spans = spans.where(F.col("recorded_at") > F.lit(checkpoint).cast("timestamp"))
    if types := list(span_types):
        spans = spans.where(F.col("span_type").isin(*types))
    if slot is not None:
        spans = spans.where(slot_of("trace_id", slots) == slot)
    return spans if limit is None else spans.orderBy("recorded_at", "span_id").limit(limit)


def slot_of(column: str, slots: int = 16):
    return F.pmod(F.xxhash64(column), F.lit(slots)).cast("int")


def slots_of_worker(index: int, workers: int, slots: int = 16) -> list[int]:
    """The slots that a worker of several owns: consecutive, one more for the first slots % workers."""
    if not 0 <= index < workers:
        raise ValueError(f"worker {index} of {workers}")
    share, more = divmod(slots, workers)
    first = index * share + min(index, more)
    return list(range(first, first + share + (index < more)))


def checkpoint_of(spans: DataFrame) -> DataFrame:
    """The newest recording time, as text."""
    return spans.agg(F.date_format(F.max("recorded_at"), "yyyy-MM-dd HH:mm:ss.SSS").alias("checkpoint"))


def span_stream(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Raw spans from a folder of Parquet files, as a stream."""
    return spark.readStream.schema(schemas.RAW_SPANS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


class PricingSource:
    """load() gives component_id, component_type, pricing."""

    def load(self, spark: SparkSession) -> DataFrame:
        raise NotImplementedError


class StaticPricing(PricingSource):
    def __init__(self, prices: Mapping[str, Mapping]) -> None:
        self.prices = prices

    def load(self, spark: SparkSession) -> DataFrame:
        rows = [(key, value.get("component_type"), {k: float(v) for k, v in value.get("pricing", {}).items()}) for key, value in self.prices.items()]
        return spark.createDataFrame(rows, PRICING)


class TablePricing(PricingSource):
    """From a table of components with is_active and pricing as JSON; any reader's options may name it (jdbc, parquet)."""

    def __init__(self, form: str = "parquet", **options: str) -> None:
        self.form, self.options = form, options

    def load(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.format(self.form).options(**self.options).load()
        prices = F.coalesce(F.from_json("pricing", "map<string,double>"), F.create_map().cast("map<string,double>"))
        return rows.where("is_active").select("component_id", "component_type", prices.alias("pricing"))


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """Each file's text as one document."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_jobs(text: str) -> list[dict]:
    """Scoring jobs from a JSON array or object, or from JSON lines if the text is none."""
    try:
        found = json.loads(text)
    except ValueError:
        return [json.loads(line) for line in text.splitlines() if line.strip()]
    return found if isinstance(found, list) else [found]


def jobs_from_text(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """read_jobs as a DataFrame of that schema."""
    lines = spark.createDataFrame([(json.dumps(row),) for row in read_jobs(text)], "line string")
    return lines.select(F.from_json("line", schema).alias("j")).select("j.*")


def read_settings(path: str | None = None, given: Mapping | None = None) -> dict:
    """Settings from a YAML or JSON file, with given ones on top, nested ones merged."""
    found: dict = {}
    if path:
        text = Path(path).read_text()
        try:
            import yaml
        except ModuleNotFoundError:
            found = json.loads(text)
        else:
            found = yaml.safe_load(text) or {}

    def merged(under: dict, over: Mapping) -> dict:
        return under | {k: merged(under[k], v) if isinstance(v, Mapping) and isinstance(under.get(k), dict) else v for k, v in over.items()}

    return merged(found, given or {})
