"""Value patterns of metrics: each gives a Column; null means that nothing is emitted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom.functions import metadata


def column_latency() -> Column:
    return F.round("latency_ms", 3)


def status_flag(*statuses: str) -> Column:
    return F.when(F.lower("span_status").isin(*statuses), 1.0).otherwise(0.0)


def metadata_numeric(path: str, strict: bool = False) -> Column:
    return metadata.number("md", path, strict)


def metadata_bool(path: str) -> Column:
    return metadata.flag("md", path)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Rounded to 4 places; null where either is missing or the denominator is 0."""
    return F.round(F.try_divide(numerator, denominator), 4)


def aggregation_derived() -> Column:
    """For metrics that are computed when read."""
    return F.lit(None).cast("double")


def ctx_value(name: str) -> Column:
    return F.col(name).cast("double")
