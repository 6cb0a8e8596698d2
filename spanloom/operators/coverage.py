"""What the registry, its evidence and its thresholds say about coverage: six views.

A threshold belongs to the entity of its own scope, so it is reduced to
(scope, slug) before any join; evidence is matched by exploding the catalog's
span types. Every join is an equi-join on small keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom import schemas


def entity_registry(entities: DataFrame) -> DataFrame:
    """kind, slug, id of all entities."""
    return entities.select("kind", "slug", "id")


def _target(thresholds: DataFrame) -> DataFrame:
    of = dict(zip(schemas.SCOPES, schemas.PATH))
    slug = F.coalesce(*(F.when(F.col("scope") == scope, F.col(name)) for scope, name in of.items()))
    return thresholds.select(F.col("scope").alias("kind"), slug.alias("slug"), F.col("metric_name"), "is_active")


def matrix(entities: DataFrame, catalog: DataFrame, observations: DataFrame, thresholds: DataFrame) -> DataFrame:
    """kind, slug, metric_name, lens, total_paths, active_paths, state for each entity and metric of its scope.

    state: dark without a span of a type that the metric needs, active if any
    threshold path is, else disabled.
    """
    offered = catalog.select("metric_name", "lens", "required_span_types", F.explode("applicable_scopes").alias("kind"))
    cells = entity_registry(entities).join(F.broadcast(offered), "kind")  # the catalog is as long as the list of specs
    needs = offered.select("metric_name", "kind", F.explode("required_span_types").alias("span_type")).distinct()
    seen = observations.select(F.col("level").alias("kind"), "slug", "span_type")
    typed = seen.join(F.broadcast(needs.where("span_type <> '*'")), ["kind", "span_type"]).select("kind", "slug", "metric_name")
    any_type = seen.select("kind", "slug").distinct().join(F.broadcast(needs.where("span_type = '*'")), "kind").select("kind", "slug", "metric_name")
    evidence = typed.union(any_type).distinct().withColumn("has_evidence", F.lit(True))
    paths = _target(thresholds).groupBy("kind", "slug", "metric_name").agg(F.count("*").alias("total_paths"), F.count_if("is_active").alias("active_paths"))
    found = cells.join(evidence, ["kind", "slug", "metric_name"], "left").join(paths, ["kind", "slug", "metric_name"], "left")
    active = F.coalesce("active_paths", F.lit(0))
    state = F.when(F.col("has_evidence").isNull(), "dark").when(active > 0, "active").otherwise("disabled")
    return found.select("kind", "slug", "id", "metric_name", "lens", F.coalesce("total_paths", F.lit(0)).alias("total_paths"), active.alias("active_paths"), state.alias("state"))


_STATES = ("active", "disabled", "dark")


def _tally(noun: str) -> list[Column]:
    return [F.count("*").alias(f"total_{noun}"), *(F.count_if(F.col("state") == state).alias(f"{state}_{noun}") for state in _STATES)]


def _percent(active: str, disabled: str) -> Column:
    """Active ones among those that evidence applies to, with one decimal; null if there are none."""
    return F.round(F.try_divide(F.lit(100.0) * F.col(active), F.col(active) + F.col(disabled)), 1)


def entity_lens_summary(cells: DataFrame) -> DataFrame:
    """By entity and lens; lens_state: dark if all metrics are, active if any metric is, else disabled."""
    sums = cells.groupBy("kind", "slug", "lens").agg(*_tally("metrics"))
    state = F.when(F.col("dark_metrics") == F.col("total_metrics"), "dark").when(F.col("active_metrics") > 0, "active").otherwise("disabled")
    return sums.withColumn("score_pct", _percent("active_metrics", "disabled_metrics")).withColumn("lens_state", state)


def entity_summary(cells: DataFrame) -> DataFrame:
    """By entity: metrics and lenses by state, and the share of both that is covered."""
    lenses = entity_lens_summary(cells)
    sums = [F.sum(f"{name}_metrics").alias(f"{name}_metrics") for name in ("total", *_STATES)]
    states = [F.count_if(F.col("lens_state") == state).alias(f"{state}_lenses") for state in _STATES]
    found = lenses.groupBy("kind", "slug").agg(*sums, F.count("*").alias("total_lenses"), *states)
    return found.withColumns({
        "applicable_lenses": F.col("active_lenses") + F.col("disabled_lenses"),
        "metric_coverage_pct": _percent("active_metrics", "disabled_metrics"),
        "lens_coverage_pct": _percent("active_lenses", "disabled_lenses"),
    })


def fleet_lens_summary(cells: DataFrame) -> DataFrame:
    """By lens, over all entities."""
    found = cells.groupBy("lens").agg(*_tally("cells"), F.count_distinct(F.struct("kind", "slug")).alias("entities"))
    return found.withColumn("score_pct", _percent("active_cells", "disabled_cells"))


def fleet_summary(cells: DataFrame) -> DataFrame:
    """One row over all entities and lenses."""
    found = cells.agg(F.count_distinct(F.struct("kind", "slug")).alias("total_entities"), *_tally("cells"))
    return found.withColumn("overall_pct", _percent("active_cells", "disabled_cells"))
