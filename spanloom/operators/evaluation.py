"""Scores of predictions against gold."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.functions import arrow


def _rates(tp: str | Column = "tp", fp: str | Column = "fp", fn: str | Column = "fn") -> dict[str, Column]:
    tp, fp, fn = (F.col(x) if isinstance(x, str) else x for x in (tp, fp, fn))
    zero = F.lit(0.0)
    precision, recall = F.coalesce(F.try_divide(tp, tp + fp), zero), F.coalesce(F.try_divide(tp, tp + fn), zero)
    return {"precision": precision, "recall": recall, "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero)}


def at_threshold(rows: DataFrame, threshold: float, score: str = "score", label: str = "label") -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 of predicting every score of at least the threshold."""
    hit, good = F.col(score) >= threshold, F.col(label) == 1
    counts = rows.agg(F.count_if(hit & good).alias("tp"), F.count_if(hit & ~good).alias("fp"), F.count_if(~hit & good).alias("fn"), F.count_if(~hit & ~good).alias("tn"))
    return counts.select("*", *(value.alias(name) for name, value in _rates().items()))


#: Buckets of running sums: each is summed by itself, so none needs all values in one task.
BUCKETS = 64


def running(rows: DataFrame, order: str, *columns: str) -> DataFrame:
    """Adds upto_<column> (the sum over rows with at most this order) and all_<column>.

    The values of order must be distinct. Rows are bucketed by approximate
    quantiles of order; a row's sum is that of the buckets before plus that
    within its own.
    """
    edges = sorted(set(rows.approxQuantile(order, [i / BUCKETS for i in range(1, BUCKETS)], 1 / (4 * BUCKETS))))
    bucket = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: F.col(order) >= e)) if edges else F.lit(0)
    held = rows.withColumn("_bucket", bucket)
    sums = held.groupBy("_bucket").agg(*(F.sum(c).alias(f"_{c}") for c in columns))  # a row for each bucket
    before, every = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    sums = sums.select("_bucket", *(F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in columns), *(F.sum(f"_{c}").over(every).alias(f"all_{c}") for c in columns))
    within = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = held.withColumns({f"_within_{c}": F.sum(c).over(within) for c in columns}).join(F.broadcast(sums), "_bucket")
    return joined.select(*rows.columns, *((F.col(f"_before_{c}") + F.col(f"_within_{c}")).alias(f"upto_{c}") for c in columns), *(f"all_{c}" for c in columns))


def _by_score(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives of each distinct score: what the curves need, whatever the number of rows."""
    return rows.groupBy(F.col(score).alias("score")).agg(F.count_if(F.col(label) == 1).alias("good"), F.count_if(F.col(label) != 1).alias("bad"))


def best_threshold(rows: DataFrame, score: str = "score", label: str = "label", steps: int = 100) -> DataFrame:
    """The threshold of a grid of `steps` + 1 with the best F1 (the smallest of equals), with its rates."""
    held = rows.groupBy(F.least(F.lit(steps), F.greatest(F.lit(-1), F.floor(F.col(score) * steps + 1e-9))).cast("int").alias("step")).agg(F.count_if(F.col(label) == 1).alias("good"), F.count_if(F.col(label) != 1).alias("bad"))
    grid = rows.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("step"))
    all_steps = grid.join(held, "step", "left").union(held.where("step < 0").select("step", "good", "bad")).na.fill(0, ["good", "bad"])
    over = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row for each step of the grid
    total = Window.partitionBy()
    swept = all_steps.select("step", F.sum("good").over(over).alias("tp"), F.sum("bad").over(over).alias("fp"), F.sum("good").over(total).alias("positives")).where("step >= 0")
    rated = swept.withColumn("fn", F.col("positives") - F.col("tp"))
    rated = rated.select((F.col("step") / steps).alias("threshold"), "tp", "fp", "fn", *(value.alias(name) for name, value in _rates().items()))
    return rated.orderBy(F.desc("f1"), "threshold").limit(1)


def auroc(rows: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve; ties count half. The ranks come from counts by score."""
    held = running(_by_score(rows, score, label).where("score IS NOT NULL").withColumn("score", F.col("score").cast("double")), "score", "bad")
    won = held.select((F.col("good") * (F.col("upto_bad") - F.col("bad") / 2.0)).alias("won"), "good", "bad")
    return won.agg(F.try_divide(F.sum("won"), F.sum("good") * F.sum("bad")).alias("auroc"))


def auprc(rows: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Average precision: the steps of recall, from the highest score down, times the precision there."""
    held = _by_score(rows, score, label).where("score IS NOT NULL").withColumn("score", F.col("score").cast("double")).withColumn("n", F.col("good") + F.col("bad"))
    held = running(held, "score", "good", "n")
    from_top = lambda name: F.col(f"all_{name}") - F.col(f"upto_{name}") + F.col(name)
    return held.agg(F.try_divide(F.sum(F.col("good") * from_top("good") / from_top("n")), F.sum("good")).alias("auprc"))


def spearman(rows: DataFrame, a: str, b: str) -> DataFrame:
    """The correlation of the ranks of two columns; equal values share their mean rank."""
    ranked = rows.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    for name in (a, b):
        counts = running(ranked.groupBy(name).agg(F.count("*").alias("n")), name, "n")
        ranked = ranked.join(counts.select(name, (F.col("upto_n") - F.col("n") + (F.col("n") + 1) / 2.0).alias(f"rank_{name}")), name)
    return ranked.agg(F.corr(f"rank_{a}", f"rank_{b}").alias("spearman"))


def overlap(a: tuple[int, int], b: tuple[int, int]) -> float:
    """Intersection over union of two spans."""
    shared = max(0, min(a[1], b[1]) - max(a[0], b[0]))
    return shared / ((a[1] - a[0]) + (b[1] - b[0]) - shared) if shared else 0.0


def match_spans(predicted: list[dict], gold: list[dict], least: float = 0.5) -> dict[str, tuple[int, int, int]]:
    """(tp, fp, fn) by type: each prediction, in order, takes the first free gold span of its type that overlaps enough."""
    free = list(range(len(gold)))
    counts: dict[str, list[int]] = {}
    for one in predicted:
        own = counts.setdefault(one["type"], [0, 0, 0])
        taken = next((i for i in free if gold[i]["type"] == one["type"] and overlap((one["start"], one["end"]), (gold[i]["start"], gold[i]["end"])) >= least), None)
        if taken is None:
            own[1] += 1
        else:
            free.remove(taken)
            own[0] += 1
    for i in free:
        counts.setdefault(gold[i]["type"], [0, 0, 0])[2] += 1
    return {kind: tuple(values) for kind, values in counts.items()}


def span_scores(docs: DataFrame, predicted: str = "predicted", gold: str = "gold", least: float = 0.5) -> DataFrame:
    """type, tp, fp, fn, precision, recall, f1 of arrays of (type, start, end), by type and for ALL.

    The greedy matching is sequential, but only within a document; counts of
    documents are summed by Spark.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(kind, *counts) for p, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for kind, counts in match_spans(p or [], g or [], least).items()]
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["type", "tp", "fp", "fn"])

    counts = arrow.by_batches(docs.select(predicted, gold), work, "type string, tp long, fp long, fn long")
    sums = [F.sum(name).alias(name) for name in ("tp", "fp", "fn")]
    every = counts.groupBy("type").agg(*sums)
    return every.union(every.agg(*sums).select(F.lit("ALL").alias("type"), "tp", "fp", "fn")).select("*", *(value.alias(name) for name, value in _rates().items()))


def bio_csv(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """document, text, gold spans from a CSV whose tokens, labels and trailing_whitespace are Python lists."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    types = names or {}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            gold = [_gold(*(ast.literal_eval(cell) for cell in cells), types) for cells in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gold, shape)], ["document", "text", "gold"])

    picked = rows.select("document", "text", "tokens", "labels", "trailing_whitespace")
    return arrow.by_batches(picked, work, "document string, text string, gold array<struct<type:string,start:bigint,end:bigint>>")


def _gold(tokens: list, labels: list, spaces: list, names: dict[str, str]) -> list[dict]:
    """Spans of BIO labels over tokens."""
    found: list[dict] = []
    at, open_kind = 0, None
    for token, label, space in zip(tokens, labels, spaces):
        kind = label[2:] if label != "O" else None
        if kind is not None and label.startswith("I-") and kind == open_kind:
            found[-1]["end"] = at + len(token)
        elif kind is not None:
            found.append({"type": names.get(kind, kind), "start": at, "end": at + len(token)})
        open_kind = kind
        at += len(token) + bool(space)
    return found
