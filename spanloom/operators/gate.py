"""Gates: which metrics are switched on for which path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom import schemas
from spanloom.functions import sides

#: A toggle's key; ids that a scope doesn't have are empty.
KEY = ("scope", *schemas.PATH, "metric")


def active_keys(thresholds: DataFrame, category: str | None = None) -> DataFrame:
    """The keys of active thresholds, of one category or all."""
    rows = thresholds.where("is_active")
    if category is not None:
        rows = rows.where(F.col("category") == category)
    blank = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    return rows.select("scope", *(blank(name) for name in schemas.PATH), F.col("metric_name").alias("metric")).distinct()


def load_toggles(thresholds: DataFrame, solutions: DataFrame, endpoints: DataFrame, workflows: DataFrame, agents: DataFrame, components: DataFrame, category: str) -> DataFrame:
    """The keys of active thresholds whose ids are surrogates: the solution must exist, other ids may be absent.

    An endpoint's key is its path, the others' is their slug.
    """
    rows = thresholds.where(F.col("is_active") & (F.col("category") == category))
    rows = rows.join(sides.small(solutions.select(F.col("id").alias("solution_fk"), F.col("slug").alias("solution_id"))), "solution_fk")
    for name, table, column in (("endpoint", endpoints, "path"), ("workflow", workflows, "slug"), ("agent", agents, "slug"), ("component", components, "slug")):
        out = "endpoint" if name == "endpoint" else f"{name}_id"
        rows = rows.join(sides.small(table.select(F.col("id").alias(f"{name}_fk"), F.col(column).alias(out))), f"{name}_fk", "left")
    blank = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    return rows.select("scope", *(blank(name) for name in schemas.PATH), F.col("metric_name").alias("metric")).distinct()


def flagged(spans: DataFrame, active: DataFrame, scopes: Column, path_columns: Callable[[Column], dict[str, Column]], name: str) -> DataFrame:
    """Adds boolean name: whether some scope's path of the span has any active metric."""
    paths = sides.small(active.select("scope", *schemas.PATH).distinct().withColumn("on", F.lit(True)))
    keyed = spans.withColumn("_scopes", scopes)
    for k in (0, 1):  # a span has two scopes at most
        scope = F.get("_scopes", F.lit(k))
        own = {column: F.col(column) for column in schemas.PATH} | {column: c for column, c in path_columns(scope).items() if column in schemas.PATH}
        side = paths.select(F.col("scope").alias("_scope"), *(F.col(column).alias(f"_{column}") for column in schemas.PATH), F.col("on").alias(f"_on{k}"))
        test = scope == F.col("_scope")
        for column, value in own.items():
            test = test & (value == F.col(f"_{column}"))
        keyed = keyed.join(side, test, "left").drop("_scope", *(f"_{column}" for column in schemas.PATH))
    return keyed.withColumn(name, F.coalesce("_on0", F.lit(False)) | F.coalesce("_on1", F.lit(False))).drop("_scopes", "_on0", "_on1")


def before(spans: DataFrame, active: DataFrame, scopes: Column, path_columns: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """The spans of which some scope's path has any active metric: a semi-join ahead of costly work."""
    return flagged(spans, active, scopes, path_columns, "_wanted").where("_wanted").drop("_wanted")


def exactly(rows: DataFrame, active: DataFrame) -> DataFrame:
    """The derived rows whose own key is active."""
    return rows.join(sides.small(active), list(KEY), "left_semi")


def needing(spans: DataFrame, active: DataFrame, metrics: list[str], scopes: Column, path_columns: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """The spans that have any of these metrics active, whether or not the metric applies to them."""
    return before(spans, active.where(F.col("metric").isin(metrics)), scopes, path_columns)


def sampled(rows: DataFrame, rate: float, column: str = "span_id") -> DataFrame:
    """A share of the rows that depends on the id alone: the first 32 bits of its SHA-256, modulo 10000."""
    if rate >= 1:
        return rows
    if rate <= 0:
        return rows.where(F.lit(False))
    return rows.where(F.conv(F.substring(F.sha2(column, 256), 1, 8), 16, 10).cast("bigint") % 10_000 < int(rate * 10_000))
