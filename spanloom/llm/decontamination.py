"""Benchmark decontamination with DataFrame functions only.

The benchmark's windows of WINDOW consecutive normalised words (of a shorter
item: all its words) are hashed; the set is broadcast while its size is within
MAX_BROADCAST_WINDOWS and joined by a shuffle beyond. Every document is turned
into hashes of its own windows, which meet the set in one join; a hit counts
once the words themselves have been compared. Each document stays one row: a
sentinel without a hash keeps those without hits.

Words are maximal runs of characters other than ASCII non-alphanumerics, with
A-Z lower-cased. Null and empty texts have no words and are never hit; items
without words or id are ignored; repeated rows and ids are judged row by row;
other columns of the documents pass through, and columns that this module adds
replace those of the same name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import common

WINDOW = 13
#: The set of windows is broadcast up to this many rows (about 300 bytes each).
MAX_BROADCAST_WINDOWS = 200_000
#: A document is contaminated if at least this share of its words is hit: one in so many.
ONE_IN = 20

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Of texts as they are, where A-Z aren't lower-cased yet.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ADDED = ("n_words", "n_hit", "n_items", "items", "hit_spans", "contaminated")


def lowered(text: str | Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: str | Column) -> Column:
    return F.filter(F.split(F.coalesce(lowered(text), F.lit("")), _BREAK, -1), lambda w: w != "")


def windows_of(benchmark: DataFrame) -> DataFrame:
    """Distinct windows: hash long, length int, window array of words, item string."""
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item"), words_of("text").alias("words"))
    items = items.where(F.size("words") > 0).select("item", "words", F.least(F.size("words"), F.lit(WINDOW)).alias("length"))
    starts = items.select("item", "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("start"))
    windows = starts.select("item", "length", F.slice("words", F.col("start"), F.col("length")).alias("window"))
    return windows.distinct().select(F.xxhash64("window").alias("hash"), "length", "window", "item")


def _hashes(words: Column, n: Column, length: int) -> Column:
    slide = F.transform(F.sequence(F.lit(1), n - F.lit(length - 1)), lambda i: F.xxhash64(F.slice(words, i, length)))
    return F.when(n >= length, slide).otherwise(F.array().cast("array<bigint>"))


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Judges every row of docs.

    Returns the columns named in keep (default: all of docs) and n_words, n_hit,
    n_items (long), items (sorted array of strings), hit_spans (array of first
    word and number of words, from 1), contaminated (boolean).
    """
    windows = windows_of(benchmark)
    sizes = {row["length"]: row["count"] for row in windows.groupBy("length").count().collect()}  # at most WINDOW rows
    if sum(sizes.values()) <= MAX_BROADCAST_WINDOWS:
        windows = F.broadcast(windows)
    kept = [name for name in (docs.columns if keep is None else keep) if name.lower() not in ADDED]
    base = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{name}`") for name in kept)).alias("kept"), words_of(f"`{text}`").alias("words")
    )
    base = base.select("*", F.size("words").alias("n"))
    lengths = sorted(sizes, reverse=True)
    hashes = F.concat(F.array(F.lit(None).cast("bigint")), *(_hashes(F.col("words"), F.col("n"), length) for length in lengths))
    slid = base.select("row", "kept", "words", "n", F.posexplode(hashes).alias("at", "hash"))
    start, length, before = F.lit(0), F.lit(0), F.lit(0)
    for size in reversed(lengths):  # the longest windows come first
        before = F.lit(0)
        for longer in lengths[: lengths.index(size)]:
            before = before + F.greatest(F.col("n") - F.lit(longer - 1), F.lit(0))
        inside = F.col("at") <= before + F.greatest(F.col("n") - F.lit(size - 1), F.lit(0))
        start, length = F.when(inside, F.col("at") - before).otherwise(start), F.when(inside, F.lit(size)).otherwise(length)
    met = slid.join(windows.withColumnRenamed("length", "window_length"), "hash", "left")
    hit = F.col("item").isNotNull() & (F.col("window_length") == length) & (F.slice("words", start, F.col("window_length")) == F.col("window"))
    met = met.where((F.col("at") == 0) | hit)
    real = F.col("at") > 0
    by_row = met.groupBy("row").agg(
        F.max(F.when(F.col("at") == 0, F.struct("n", "kept"))).alias("first") if _orderable(docs, kept) else F.first(F.when(F.col("at") == 0, F.struct("n", "kept")), True).alias("first"),
        F.collect_set(F.when(real, F.struct(start.alias("start"), length.alias("length")))).alias("hits"),
        F.collect_set(F.when(real, F.col("item"))).alias("found"),
    )
    zero = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate(
        F.array_sort("hits"),
        zero,
        lambda acc, span: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), span["start"] + span["length"] - F.greatest(acc["end"], span["start"]))).alias("hit"),
            F.greatest(acc["end"], span["start"] + span["length"]).alias("end"),
        ),
    )["hit"]
    judged = by_row.select(
        "first.kept.*",
        F.col("first.n").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"), F.size("found").cast("long").alias("n_items"),
        F.array_sort("found").alias("items"), F.array_sort("hits").alias("hit_spans"),
    )
    return judged.withColumn("contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))


def _orderable(docs: DataFrame, kept: list[str]) -> bool:
    """max() of plain columns aggregates without objects; maps and variants can't be ordered."""
    return all(kind in ("bigint", "int", "string", "double", "boolean") for name, kind in docs.dtypes if name in kept)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """docs without contaminated rows; rows with fewer hits lose the words of these hits.

    Words that come together where others were removed can make a window. So
    rows that lost words are scanned again, and lose the words of new hits,
    however many, until no window is left. The columns are those of docs; rows
    without hits are unchanged.
    """
    changed = common.fresh_name(docs, "changed")
    kept = common.cut(_stripped(scan(docs, benchmark, text).where(~F.col("contaminated")), docs.columns, text, changed))
    clean = kept.where(~F.col(changed))
    while (left := kept.where(changed)).limit(1).count():
        kept = common.cut(_stripped(scan(left.drop(changed), benchmark, text), docs.columns, text, changed))
        clean = clean.union(kept.where(~F.col(changed)))
    return clean.drop(changed)


def _stripped(judged: DataFrame, names: list[str], text: str, changed: str) -> DataFrame:
    """The columns of these names, the text without the words that are hit, and whether there were any."""
    column = F.col(f"`{text}`")
    words, gaps = F.regexp_extract_all(column, F.lit(f"({_WORD})"), F.lit(1)), F.split(column, _WORD, -1)
    inside = lambda i: F.exists("hit_spans", lambda s: (s["start"] <= i + 1) & (i + 1 < s["start"] + s["length"]))
    kept = F.transform(words, lambda word, i: F.when(inside(i), F.lit("")).otherwise(word))
    rebuilt = F.array_join(F.zip_with(gaps, kept, lambda gap, word: F.concat(gap, F.coalesce(word, F.lit("")))), "")
    hit = F.col("n_hit") > 0
    return judged.select(*(F.when(hit, rebuilt).otherwise(column).alias(name) if name == text else F.col(f"`{name}`") for name in names), hit.alias(changed))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    judged = scan(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "n_hit", "n_items", common.sha256_of(F.col("items")).alias("items_sha256"), "contaminated")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bl AS (SELECT item, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
ln AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ln WHERE len(w) >= n)),
h AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
p AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS q FROM h) GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
