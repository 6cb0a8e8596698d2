"""Discovery of entities from spans, and the tables that follow from them.

All steps are key merges of small distinct projections, so replaying a batch
changes nothing. Ids are hashes of kind and slug.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom import schemas

KINDS = {"solution": "solution_id", "endpoint": "endpoint", "workflow": "workflow_id", "agent": "agent_id", "component": "component_id"}
ENTITY_KEY = ("kind", "slug")


def entity_id(kind: str | Column, slug: str | Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", kind, slug), 256), 1, 32)


def entities(spans: DataFrame) -> DataFrame:
    """kind, slug, id, solution_id, component_type, path of all entities that spans name.

    An endpoint belongs to its first solution, a component has the type that it
    first had (components without a type are left out); an endpoint's path is
    its slug.
    """
    first = F.struct("recorded_at", "span_id")
    parts = []
    for kind, column in KINDS.items():
        rows = spans.where(F.col(column) != "")
        if kind == "component":
            rows = rows.where(F.col("component_type") != "")
        owner = F.min("solution_id") if kind == "endpoint" else F.lit(None).cast("string")
        typed = F.min_by("component_type", first) if kind == "component" else F.lit(None).cast("string")
        grouped = rows.groupBy(F.col(column).alias("slug")).agg(owner.alias("solution_id"), typed.alias("component_type"))
        parts.append(grouped.select(F.lit(kind).alias("kind"), "slug", "solution_id", "component_type", (F.col("slug") if kind == "endpoint" else F.lit(None).cast("string")).alias("path")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumn("id", entity_id("kind", "slug"))


def merge(old: DataFrame, new: DataFrame, keys: tuple[str, ...] | list[str], prefer_new: tuple[str, ...] = ()) -> DataFrame:
    """Rows of both by key: columns of old stay unless named in prefer_new; a missing value is taken from the other side."""
    others = [name for name in old.columns if name not in keys]
    joined = old.alias("o").join(new.alias("n"), [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full_outer")
    pick = lambda name: F.coalesce(F.col(f"n.{name}"), F.col(f"o.{name}")) if name in prefer_new else F.coalesce(F.col(f"o.{name}"), F.col(f"n.{name}"))
    return joined.select(*(F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys), *(pick(name).alias(name) for name in others)).select(old.columns)


def absent(new: DataFrame, old: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """Rows of new whose key old doesn't have; nulls are equal to each other."""
    on = [new[k].eqNullSafe(old[k]) for k in keys]
    test = on[0]
    for one in on[1:]:
        test = test & one
    return new.join(old, test, "left_anti")


def bindings(spans: DataFrame) -> DataFrame:
    """Distinct paths that have a solution and an endpoint; missing ids are null."""
    rows = spans.where((F.col("solution_id") != "") & (F.col("endpoint") != ""))
    return rows.select("solution_id", "endpoint", *(F.nullif(F.col(name), F.lit("")).alias(name) for name in ("workflow_id", "agent_id", "component_id"))).distinct()


def observations(spans: DataFrame) -> DataFrame:
    """level, slug, span_type, first_seen, last_seen, sample_count: each span counts for all five of its ancestors."""
    levels = F.array(*(F.struct(F.lit(kind).alias("level"), F.col(column).alias("slug")) for kind, column in KINDS.items()))
    rows = spans.select("span_type", "recorded_at", F.explode(F.filter(levels, lambda x: x["slug"] != "")).alias("e"))
    return rows.groupBy("e.level", "e.slug", "span_type").agg(F.min("recorded_at").alias("first_seen"), F.max("recorded_at").alias("last_seen"), F.count("*").alias("sample_count"))


def merge_observations(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts add up, the first and last sighting widen."""
    return old.unionByName(new).groupBy("level", "slug", "span_type").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("sample_count").alias("sample_count"))


THRESHOLD_KEY = ("metric_name", "scope", *schemas.PATH)


def seeded(bound: DataFrame, solutions: DataFrame, catalog: DataFrame, existing: DataFrame | None = None, only: DataFrame | None = None) -> DataFrame:
    """Inactive thresholds for every metric, scope and path that the catalog allows and that existing lacks.

    Solutions come from their registry (slug), deeper scopes from bindings; ids
    below a scope are null. only: the solutions (solution_id) to seed, all if none is given.
    """
    offered = catalog.select(F.col("lens").alias("category"), "metric_name", F.explode("applicable_scopes").alias("scope"), F.col("default_window").alias("time_window"), F.col("default_operator").alias("operator"))
    null = F.lit(None).cast("string")
    paths = solutions.select(F.lit("solution").alias("scope"), F.col("slug").alias("solution_id"), *(null.alias(name) for name in schemas.PATH[1:]))
    for depth, scope in enumerate(("endpoint", "workflow", "agent", "component"), 1):
        held = schemas.PATH[: depth + 1]
        rows = bound.where(F.col(held[-1]).isNotNull()).select(F.lit(scope).alias("scope"), *held, *(null.alias(name) for name in schemas.PATH[depth + 1 :]))
        paths = paths.union(rows.select("scope", *schemas.PATH))
    if only is not None:
        paths = paths.join(only.select("solution_id"), "solution_id", "left_semi").select("scope", *schemas.PATH)
    number = F.lit(None).cast("double")
    rows = paths.distinct().join(F.broadcast(offered), "scope").select(  # the catalog is as long as the list of specs
        "category", "metric_name", "scope", "time_window", "operator", number.alias("warning_value"), number.alias("critical_value"), *schemas.PATH, F.lit(False).alias("is_active"),
    )
    return rows if existing is None else absent(rows, existing, list(THRESHOLD_KEY))


def reconcile(spans: DataFrame, catalog: DataFrame, state: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All registry tables after a batch of spans: entities, bindings, observations, thresholds."""
    found, bound, seen = entities(spans), bindings(spans), observations(spans)
    if state is not None:
        found = merge(state["entities"], found, ENTITY_KEY)
        bound = state["bindings"].unionByName(bound).distinct()
        seen = merge_observations(state["observations"], seen)
    new = seeded(bound, found.where("kind = 'solution'").select("slug"), catalog, None if state is None else state["thresholds"])
    thresholds = new if state is None else state["thresholds"].unionByName(new)
    return {"entities": found, "bindings": bound, "observations": seen, "thresholds": thresholds}
