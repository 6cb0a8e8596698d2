"""Nearest neighbours by multi-index hashing over learned rotated binary codes.

Rotations (principal components, then iterative quantisation from different
starts) are learned on a bounded sample; the signs of rotated vectors are
BITS-bit codes. A block of rows has an index for each of the code's 16-bit
substrings: the values that occur, and the rows that have each. A query probes,
by the pigeonhole principle, the values near its own in every index, which
retrieves every code within a Hamming radius; of the retrieved rows, those whose
whole codes are within the radius are ranked by their inner product in double
precision, and no others. The radius comes from the true neighbours of sample
vectors and gives a recall of RECALL there. Queries that find fewer rows than
are wanted are searched again, without a radius.

Inner products are reduced to distances by one more component that fills every
vector up to the largest norm. Equal vectors are indexed once, with their
smallest ids, and equal queries are searched once.

Rows with a null id, and vectors that are null, empty, zero or hold null or
non-finite components, take no part. All others do: shorter vectors count as
filled up with zeros. Rows that repeat an id and its vector count once; an id
with several vectors has a row for each, and asks with each. Ties go to the
smaller id. Other columns, whatever their names, play no part. An empty table
has no queries; a query without other rows has no neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.llm import common

BITS = 128
#: Bits of a substring, which is a key of its own index.
WIDTH = 16
RECALL = 0.98
#: Bounds of what is learned from: vectors, and those of them that are searched for the radius.
SAMPLE = 20_000
PROBES = 400
ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 8192
#: Queries of a block that are searched at once; by how much sums of products may differ in their order.
_AT_ONCE = 256
_ROUNDING = 1e-9
#: Share of a block from which whole arrays are worked on instead of lists; the rows found are the same.
_DENSE = 0.1
NEIGHBOURS = 20

_SUBSTRINGS = BITS // WIDTH
_WORDS = BITS // 64


@dataclass
class Codes:
    """The learned rotations, and the Hamming radius that a search uses. scale: the largest component; norm: of the scaled vectors."""

    centre: np.ndarray
    rotation: np.ndarray
    scale: float
    norm: float
    radius: int = BITS

    def widened(self, vectors: np.ndarray, stored: bool) -> np.ndarray:
        """The scaled vectors with one more component: stored ones reach the largest norm, queries get zero."""
        vectors = vectors / self.scale
        last = np.sqrt(np.maximum(0.0, self.norm**2 - (vectors**2).sum(axis=1))) if stored else np.zeros(len(vectors))
        return np.column_stack([vectors, last])

    def of(self, vectors: np.ndarray, stored: bool) -> np.ndarray:
        signs = (self.widened(vectors, stored) - self.centre) @ self.rotation > 0
        return np.packbits(signs, axis=1, bitorder="little").view(np.uint64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of codes, row by row."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def learn(vectors: np.ndarray, scale: float, norm: float, wanted: int = NEIGHBOURS, rounds: int = 30, seed: int = 3) -> Codes:
    """Rotations and radius from a sample of vectors; scale and norm are the largest of all rows."""
    rng = np.random.default_rng(seed)
    codes = Codes(np.zeros(vectors.shape[1] + 1), np.zeros((vectors.shape[1] + 1, BITS)), scale, norm)
    wide = codes.widened(vectors, True)
    codes.centre = wide.mean(axis=0)
    _, axes = np.linalg.eigh(np.cov((wide - codes.centre).T) + 1e-12 * np.eye(wide.shape[1]))
    axes = axes[:, ::-1][:, :64]
    while axes.shape[1] < 64:  # short vectors: further random directions
        more = np.linalg.qr(rng.standard_normal((wide.shape[1], wide.shape[1])))[0]
        axes = np.column_stack([axes, more])[:, :64]
    flat = (wide - codes.centre) @ axes
    turns = []
    for _ in range(_WORDS):
        turn = np.linalg.qr(rng.standard_normal((64, 64)))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.sign(flat @ turn).T @ flat)
            turn = (left @ right).T
        turns.append(axes @ turn)
    codes.rotation = np.column_stack(turns)
    probes = rng.permutation(len(vectors))[:PROBES]
    stored, asked = codes.of(vectors, True), codes.of(vectors[probes], False)
    near = []
    for probe, code in zip(probes, asked):
        scores = vectors @ (vectors[probe] / scale)
        scores[probe] = -np.inf
        best = np.argsort(-scores)[: min(wanted, len(vectors) - 1)]
        near.append(distances(stored[best], code))
    if near and len(near[0]):
        codes.radius = int(np.quantile(np.concatenate(near), RECALL, method="higher"))
    return codes


class Index:
    """A block's rows, for each substring under the values that occur."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.tables = []
        for part in self._parts(codes).T:
            values, of, size = np.unique(part, return_inverse=True, return_counts=True)
            self.tables.append((values, of, np.argsort(part, kind="stable"), np.cumsum(size) - size, size))

    @staticmethod
    def _parts(codes: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(codes).view(np.uint16).reshape(len(codes), _SUBSTRINGS)

    def within(self, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (number of a query code, row) of codes within the radius; and how many rows each query's probes retrieved.

        If a code is within it, one of the substrings is within its own radius,
        as the radii and their number less one add up to the whole.
        """
        spare = max(0, radius - _SUBSTRINGS + 1)
        met = np.zeros((len(asked), len(self.codes)), bool)
        for k, (own, (values, of, rows, starts, sizes)) in enumerate(zip(self._parts(asked).T, self.tables)):
            least = spare // _SUBSTRINGS + (k < spare % _SUBSTRINGS)
            near = np.bitwise_count(own[:, None] ^ values[None, :]) <= least
            if near.mean() > _DENSE:  # so many values are near that going through the rows is quicker than through their lists
                met |= near[:, of]
                continue
            number, probe = np.nonzero(near)
            size = sizes[probe]
            at = np.repeat(starts[probe] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            met[np.repeat(number, size), rows[at]] = True
        probed = met.sum(axis=1)
        if met.mean() > _DENSE:
            apart = sum(np.bitwise_count(asked[:, None, k] ^ self.codes[None, :, k]).astype(np.uint16) for k in range(_WORDS))
            number, row = np.nonzero(met & (apart <= radius))
            return number, row, probed
        number, row = np.nonzero(met)
        close = distances(asked[number], self.codes[row]) <= radius
        return number[close], row[close], probed


def search_block(codes: Codes, vectors: np.ndarray, ids: list[list[int]], queries: np.ndarray, wanted: int, radius: int) -> Iterator[tuple[int, int, float | None, bool, int, int]]:
    """(query's number, id, inner product, whether it is the query's own vector, 0, 0) of the best `wanted` rows of a block.

    Each query has also one row (number, None, None, False, rows that its probes retrieved, rows that were ranked).
    """
    index = Index(codes.of(vectors, True))
    for first in range(0, len(queries), _AT_ONCE):
        points = queries[first : first + _AT_ONCE]
        number, row, probed = index.within(codes.of(points, False), radius)
        ranked = np.bincount(number, minlength=len(points))
        for k, end in enumerate(np.cumsum(ranked)):
            yield first + k, None, None, False, int(probed[k]), int(ranked[k])
            rows = row[end - ranked[k] : end]
            if len(rows) > wanted:  # products in any order of additions first: all that may be among the best stay
                rough = vectors[rows] @ points[k]
                least = np.partition(rough, len(rows) - wanted)[len(rows) - wanted]
                rows = rows[~(rough < least - _ROUNDING * (abs(least) + np.abs(rough).max()))]
            scores = (vectors[rows] * points[k]).sum(axis=1)
            for score, one, own in sorted((-score, one, bool((vectors[i] == points[k]).all())) for i, score in zip(rows, scores) for one in ids[i])[:wanted]:
                yield first + k, one, -score, own, 0, 0


def _usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector (array of double, all of one length) of the rows that take part, each once."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where("vec_id IS NOT NULL AND size(vector) > 0")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(fine)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    filled = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("vector")))
    return rows.select("vec_id", F.when(F.size("vector") == longest, F.col("vector")).otherwise(filled).alias("vector")).distinct()


def _matrix(table: pa.Table) -> np.ndarray:
    vectors = table.column("vector").combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def nearest(embeddings: DataFrame, every: int = 20, neighbours: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows whose vec_id is divisible by `every`, their nearest other rows.

    n_probed and n_ranked tell how many different vectors the query's probes
    retrieved, and for how many of them an inner product was computed.
    """
    spark = embeddings.sparkSession
    rows = common.cut(_usable(embeddings))
    wanted = neighbours + 1  # the query's own row is among them
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    smallest = rows.withColumn("at", F.row_number().over(by_vector)).where(F.col("at") <= wanted)
    stored = common.cut(smallest.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))  # at most `wanted` ids
    asking = rows.where(F.col("vec_id") % every == 0)
    asked = common.cut(asking.groupBy("vector").agg(F.min("vec_id").alias("least")).select("vector", F.monotonically_increasing_id().alias("asker")))
    n, q = stored.count(), asked.count()
    drawn = stored.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toArrow()
    scale = stored.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 1.0
    norm = stored.agg(F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x / scale) * (x / scale))))).first()[0] or 0.0
    model = learn(_matrix(drawn), scale, norm, neighbours) if drawn.num_rows > 1 else None
    codes = spark.sparkContext.broadcast(model)
    blocks = max(1, -(-n // ROWS_PER_BLOCK))
    common.ship(spark)

    def dealt(frame: DataFrame, own: str, count: int, other: str, times: int) -> DataFrame:
        return frame.withColumn(own, F.pmod(F.xxhash64("vector"), F.lit(count).cast("long"))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(times - 1).cast("long"))))

    def search(asked: DataFrame, q: int, radius: int) -> DataFrame:
        """Every query against the rows of every block."""
        groups = max(1, -(-q // QUERIES_PER_BLOCK))
        left, right = dealt(stored, "block", blocks, "part", groups), dealt(asked, "part", groups, "block", blocks)

        def work(key: tuple, held: pa.Table, queries: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if held.num_rows and queries.num_rows:
                vectors = _matrix(held)
                model = codes.value or Codes(np.zeros(vectors.shape[1] + 1), np.ones((vectors.shape[1] + 1, BITS)), scale, norm)
                out = list(search_block(model, vectors, held.column("ids").to_pylist(), _matrix(queries), wanted, radius))
            asker = queries.column("asker").to_numpy()[np.array([row[0] for row in out], np.int64)]
            columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate((pa.int64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64()), 1)]
            return pa.table([pa.array(asker, pa.int64()), *columns], ["asker", "vec_id", "score", "own", "probed", "ranked"])

        return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(work, "asker long, vec_id long, score double, own boolean, probed long, ranked long")

    found = common.cut(search(asked, q, model.radius if model else BITS))
    enough = min(wanted, n)
    few = common.cut(found.groupBy("asker").agg(F.count("vec_id").alias("times")).where(F.col("times") < enough).join(asked, "asker").select("vector", "asker"))
    if again := few.count():
        found = found.join(few.select("asker"), "asker", "left_anti").union(search(few, again, BITS))
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
    merged = found.where("vec_id IS NOT NULL").withColumn("at", F.row_number().over(best)).where(F.col("at") <= wanted).select("asker", "vec_id", "score", "own")
    told = found.groupBy("asker").agg(F.sum("probed").alias("n_probed"), F.sum("ranked").alias("n_ranked"))
    askers = asking.withColumnRenamed("vec_id", "query_id").join(asked, "vector").select("query_id", "asker", F.monotonically_increasing_id().alias("row"))
    pairs = askers.join(merged, "asker").where("NOT (own AND query_id = vec_id)")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= neighbours).join(told, "asker").select("query_id", "rank", "vec_id", "score", "n_probed", "n_ranked")


def op8_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    return nearest(common.table(spark, sf_dir, "embeddings"))
