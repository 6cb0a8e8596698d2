"""One-minute partial states of derived metrics, and what is read from them.

States merge: counts and sums add up, extrema and KLL sketches combine, averages
are kept as sum and count. Late rows simply add another state of their minute;
readers merge whatever is there, so there is no watermark to miss. The endpoint
is part of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom import schemas

STATES = ("count", "sum_value", "min_value", "max_value", "quantiles", "confidence_sum", "confidence_count")


def base(derived: DataFrame, every: str = "minute", quantiles: bool = True) -> DataFrame:
    """States of the rows' minutes."""
    states = [
        F.count("*").alias("count"), F.sum("value").alias("sum_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.sum(F.col("confidence").cast("double")).alias("confidence_sum"), F.count("confidence").alias("confidence_count"),
    ]
    if quantiles:
        states.append(F.kll_sketch_agg_double("value").alias("quantiles"))
    return derived.groupBy(*schemas.ROLLUP_KEYS, F.date_trunc(every, "ts").alias("ts")).agg(*states)


def merge(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """The states merged by these keys; still states."""
    merged = [
        F.sum("count").alias("count"), F.sum("sum_value").alias("sum_value"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.sum("confidence_sum").alias("confidence_sum"), F.sum("confidence_count").alias("confidence_count"),
    ]
    if "quantiles" in states.columns:
        merged.append(F.kll_merge_agg_double("quantiles").alias("quantiles"))
    return states.groupBy(*keys).agg(*merged)


def cascade(states: DataFrame, every: str = "hour") -> DataFrame:
    """States of a wider grain, from those of a finer one."""
    return merge(states, [*schemas.ROLLUP_KEYS, F.date_trunc(every, "ts").alias("ts")])


def read(states: DataFrame, keys: Sequence[str | Column], quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Values merged by these keys: count, sum, average, extrema, average confidence, and quantiles where there are sketches."""
    merged = merge(states, keys)
    names = [name for name in merged.columns if name not in STATES]
    values = [F.col("count"), F.col("sum_value"), F.try_divide("sum_value", "count").alias("avg_value"), F.col("min_value"), F.col("max_value"), F.try_divide("confidence_sum", "confidence_count").alias("avg_confidence")]
    if "quantiles" in merged.columns:
        values += [F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q))).alias(f"p{round(q * 100)}") for q in quantiles]
    return merged.select(*names, *values)


def since(rows: DataFrame, start: str | Column, end: str | Column | None = None) -> DataFrame:
    """Rows of a window of time, from start (inclusive) to end (exclusive)."""
    start = F.lit(start).cast("timestamp") if isinstance(start, str) else start
    out = rows.where(F.col("ts") >= start)
    if end is not None:
        out = out.where(F.col("ts") < (F.lit(end).cast("timestamp") if isinstance(end, str) else end))
    return out


def expired(rows: DataFrame, column: str, days: int, as_of: str) -> DataFrame:
    """What is left after a time to live."""
    return rows.where(F.col(column) >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS"))


def cost_by_component(states: DataFrame) -> DataFrame:
    """Total cost by component, dearest first."""
    costs = states.where("metric = 'cost'").groupBy("component_id").agg(F.round(F.sum("sum_value"), 9).alias("total_cost"))
    return costs.orderBy(F.desc("total_cost"), "component_id")


def throughput(states: DataFrame, keys: Sequence[str] = ("solution_id",)) -> DataFrame:
    """Spans a second, by minute."""
    rows = states.where("metric = 'latency'")
    return rows.groupBy(*keys, F.date_trunc("minute", "ts").alias("minute")).agg((F.sum("count") / F.lit(60.0)).alias("throughput"))


def concurrency(states: DataFrame, keys: Sequence[str] = ("solution_id",)) -> DataFrame:
    """Average latency (ms) times spans a second, by minute."""
    rows = states.where("metric = 'latency'").groupBy(*keys, F.date_trunc("minute", "ts").alias("minute"))
    sums = rows.agg(F.sum("sum_value").alias("total"), F.sum("count").alias("n"))
    return sums.select(*keys, "minute", (F.try_divide("total", "n") * (F.col("n") / F.lit(60.0))).alias("concurrency"))


def overlapping(spans: DataFrame, keys: Sequence[str] = ("solution_id",)) -> DataFrame:
    """The most spans that were open at once, by key and hour of their start or end: a sweep over +1 and -1 events.

    Events are first summed by instant, so the running sum meets each instant
    once, and by minute, so a window holds no more than a key's minute.
    """
    events = spans.select(*keys, F.explode(F.array(F.struct(F.col("started_at").alias("at"), F.lit(1).alias("change")), F.struct(F.col("ended_at").alias("at"), F.lit(-1).alias("change")))).alias("e"))
    summed = events.groupBy(*keys, F.date_trunc("minute", "e.at").alias("minute"), F.col("e.at").alias("at")).agg(F.sum("e.change").alias("change"))
    within = F.sum("change").over(Window.partitionBy(*keys, "minute").orderBy("at"))
    minutes = summed.withColumn("within", within).groupBy(*keys, "minute").agg(F.sum("change").alias("total"), F.max("within").alias("most"))
    before = F.sum("total").over(Window.partitionBy(*keys).orderBy("minute").rowsBetween(Window.unboundedPreceding, -1))  # a row for each minute of a key
    found = minutes.withColumn("before", F.coalesce(before, F.lit(0)))
    return found.groupBy(*keys, F.date_trunc("hour", "minute").alias("hour")).agg(F.max(F.col("before") + F.col("most")).alias("most_open"))


def _costs(states: DataFrame, key: str) -> DataFrame:
    return states.where("metric = 'cost'").groupBy(key).agg(F.sum("sum_value").alias("spent"))


def burn_rate(states: DataFrame, hours: float, key: str = "solution_id") -> DataFrame:
    return _costs(states, key).select(key, F.round(F.col("spent") / F.lit(float(hours)), 8).alias("burn_rate"))


def projected_cost(states: DataFrame, hours: float, horizon_hours: float, key: str = "solution_id") -> DataFrame:
    return _costs(states, key).select(key, F.round(F.col("spent") / F.lit(float(hours)) * F.lit(float(horizon_hours)), 8).alias("projected_cost"))


def budget_utilization(states: DataFrame, budget: float, key: str = "solution_id") -> DataFrame:
    return _costs(states, key).select(key, F.round(F.try_divide(F.col("spent"), F.lit(float(budget))), 8).alias("budget_utilization"))


def infrastructure_cost(states: DataFrame, allocated: float, key: str = "solution_id") -> DataFrame:
    """A given amount, allocated by each key's share of the spans."""
    spans = states.where("metric = 'latency'").groupBy(key).agg(F.sum("count").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row for each key
    return spans.select(key, F.round(F.lit(float(allocated)) * F.col("n") / total, 8).alias("infrastructure_cost"))


def cost_per(states: DataFrame, metric: str, name: str, key: str = "solution_id", by: str = "sum_value") -> DataFrame:
    """Cost over the sum (or count) of another metric: outcomes or records; null where there are none."""
    amount = lambda which, what: F.sum(F.when(F.col("metric") == which, F.col(what)))
    sums = states.groupBy(key).agg(amount("cost", "sum_value").alias("spent"), amount(metric, by).alias("n"))
    return sums.select(key, F.round(F.try_divide("spent", "n"), 8).alias(name))
