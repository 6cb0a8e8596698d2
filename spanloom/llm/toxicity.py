"""Toxicity scoring with subword-bag embeddings and a linear softmax.

A text is the bag of its character n-grams. Every n-gram hashes to one row of
an embedding table; the rows of a text are averaged (with inverse-frequency
weights, so that the few telling n-grams of a long text are not drowned) and a
linear softmax turns the average into a label. Table and softmax are trained
jointly, in numpy, in one task, over a bounded sample of labelled rows; the
driver holds only what the task returns. A misspelt word shares most n-grams
with the word it stands for, so it shares its vectors too.

Once trained, ``softmax(W . mean(E))`` needs of every n-gram only its dot
product with the softmax's weight, so what executors receive is one float per
hash row (``2 ** BUCKET_BITS`` floats, whatever the corpus).

A null or empty text has the score of the model's bias. Whole texts are scored,
whatever their length; equal texts, and so repeated rows, have equal scores. An
empty table of documents gives no rows, one of labels a model that gives 0.5 to
every text. Columns that the operator adds replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import common

BUCKET_BITS = 20
DIM = 8
NGRAMS = (4, 6, 8)
#: Bounds of the training sample: labelled rows, and characters of a text that may be one of them.
MAX_TRAINING_ROWS = 12_000
MAX_TRAINING_CHARS = 100_000
EPOCHS = 8
#: Hash rows that fewer training texts have are left out of averages; how strongly frequent ones are damped.
MIN_TEXTS = 8
COMMON = 50.0
LEARNING_RATE = 0.5
THRESHOLD = 0.3

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32
_CHUNK = 256
#: A factor for each place in a word, by which whole words are hashed.
_PLACES = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64)


def _bytes_of(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct lower-cased words of every text, as UTF-8 with single blanks around them, in one array; whose text each byte is."""
    parts = [" ".join(["", *dict.fromkeys((text or "").lower().split()), ""]).encode("utf-8", "replace") for text in texts]
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(part) for part in parts])
    return np.frombuffer(b"".join(parts), np.uint8), owner


def grams(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash rows of n-grams, and whose text each is: an array pair for each n, and one for whole words.

    N-grams stay within a word and its bordering blanks. A word that a text
    repeats counts once, so that repetition doesn't outweigh content.
    """
    data, owner = _bytes_of(texts)
    shift = np.uint64(64 - BUCKET_BITS)
    blank = np.zeros(len(data) + 1, np.int32)
    np.cumsum(data == _SPACE, out=blank[1:])
    code, done = data.astype(np.uint64), 1
    for n in NGRAMS:
        size = len(data) - n + 1
        if size <= 0:
            break
        for k in range(done, n):
            code = (code[: len(data) - k] << np.uint64(8)) | data[k:]
        done = n
        keep = np.flatnonzero(blank[n - 1 : n - 1 + size] == blank[1 : 1 + size])
        yield (((code[keep] + np.uint64(n)) * _MULTIPLIER) >> shift).astype(np.int32), owner[keep]
    heads = np.flatnonzero((data[:-1] == _SPACE) & (data[1:] != _SPACE))
    if len(heads):
        place = np.arange(len(data)) - np.repeat(np.concatenate([[0], heads]), np.diff(np.concatenate([[0], heads, [len(data)]])))
        factor = _PLACES[place % len(_PLACES)]
        if place.max() >= len(_PLACES):  # another odd factor for every further turn, so each place has its own
            factor = factor * (2 * (place // len(_PLACES)) + 1).astype(np.uint64)
        part = np.where(data == _SPACE, np.uint64(0), factor * data)
        yield ((np.add.reduceat(part, heads) * _MULTIPLIER) >> shift).astype(np.int32), owner[heads]


class _Bags:
    """Each text's distinct hash rows with their counts, later their shares, in flat arrays of _CHUNK texts."""

    def __init__(self, texts: Iterable[str | None]) -> None:
        self.chunks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0
        texts = iter(texts)
        while some := list(islice(texts, _CHUNK)):
            codes = [(owner.astype(np.int64) << BUCKET_BITS) | ids for ids, owner in grams(some)]
            codes, counts = np.unique(np.concatenate(codes or [np.zeros(0, np.int64)]), return_counts=True)
            ends = np.searchsorted(codes, np.arange(len(some) + 1) << BUCKET_BITS)
            self.chunks.append(((codes & ((1 << BUCKET_BITS) - 1)).astype(np.int32), counts.astype(np.min_scalar_type(counts.max(initial=0))), ends))
            self.size += len(some)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        ids, shares, ends = self.chunks[i // _CHUNK]
        part = slice(ends[i % _CHUNK], ends[i % _CHUNK + 1])
        return ids[part], shares[part]

    def share(self, weight: np.ndarray, place: np.ndarray) -> None:
        """Drops hash rows without weight, renames the others to their places, and turns counts into shares of a text's weight."""
        for k, (ids, counts, ends) in enumerate(self.chunks):
            known = weight[ids] > 0
            ends = np.concatenate([[0], np.cumsum(known)])[ends]
            ids, part = ids[known], weight[ids[known]] * counts[known].astype(np.int32)
            owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            total = np.bincount(owner, part, len(ends) - 1)
            self.chunks[k] = place[ids], (part / total[owner]).astype(np.float32), ends


@dataclass
class Model:
    """Per hash row: its averaging weight and weight x (softmax logit of its vector)."""

    weight: np.ndarray
    pull: np.ndarray
    bias: float

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probability of the toxic label; a text without n-grams gets the bias alone."""
        weight, pulled = np.zeros(len(texts)), np.zeros(len(texts))
        for ids, owner in grams(texts):
            weight += np.bincount(owner, self.weight[ids], len(texts))
            pulled += np.bincount(owner, self.pull[ids], len(texts))
        logit = np.where(weight > 0, pulled / np.maximum(weight, 1e-9), 0.0) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def train(texts: Iterable[str | None], labels: Sequence[int], seed: int = 7) -> Model:
    """Fits embeddings and softmax by stochastic gradient descent with per-row adaptive steps.

    labels may be filled while texts are read. Every text is a step of its own.
    """
    rng = np.random.default_rng(seed)
    docs = _Bags(texts)
    labels = np.asarray(labels, np.int64)
    size = 1 << BUCKET_BITS
    seen = np.zeros(size, np.float32)
    for ids, _, _ in docs.chunks:
        seen += np.bincount(ids, minlength=size)
    weight = ((seen >= MIN_TEXTS) / (1.0 + COMMON * seen / max(1, docs.size))).astype(np.float32)
    live = np.flatnonzero(weight)
    place = np.zeros(size, np.int32)
    place[live] = np.arange(len(live))
    docs.share(weight, place)
    pulls = np.zeros(size, np.float32)
    if not docs.size:
        return Model(pulls, pulls, 0.0)
    table = rng.standard_normal((len(live), DIM), np.float32) * np.float32(0.05)
    softmax = (rng.standard_normal((2, DIM)) * 0.3).astype(np.float32)
    bias = np.log(np.bincount(labels, minlength=2) + 1.0)
    speed = np.full(len(live), 1e-4, np.float32)
    for epoch in range(EPOCHS):
        step = np.float32(LEARNING_RATE * (1 - epoch / EPOCHS))
        for i in rng.permutation(docs.size):
            ids, share = docs[i]
            if not len(ids):
                continue
            vectors = table[ids]
            mean = share @ vectors
            logits = softmax @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            pull = softmax.T @ p.astype(np.float32)
            fast = speed[ids] + share * share * (pull @ pull)
            speed[ids] = fast
            softmax -= (0.1 * step * np.outer(p, mean)).astype(np.float32)
            bias -= 0.01 * step * p
            vectors -= (step * share / np.sqrt(fast))[:, None] * pull
            table[ids] = vectors
    pulls[live] = weight[live] * (table @ (softmax[1] - softmax[0]))
    return Model(weight, pulls, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None) -> Model:
    """Trains on at most MAX_TRAINING_ROWS labelled rows, those whose ids have the smallest hashes.

    docs: doc_id, text. labels: doc_id, toxic. keep: which rows of labels may
    be learnt from. Rows with a null id, label or text are not learnt from, nor
    are texts over MAX_TRAINING_CHARS. A document that occurs more than once
    counts once; if its labels differ, it is toxic. Without any labelled row
    the model gives 0.5 to every text.
    """
    labelled = labels if keep is None else labels.where(keep)
    chosen = (
        labelled.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAINING_ROWS)
    )
    rows = (
        docs.select("doc_id", "text").where(F.length("text") <= MAX_TRAINING_CHARS)
        .join(F.broadcast(chosen), "doc_id")
        .dropDuplicates(["doc_id"])
    )
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: list[int] = []

        def texts() -> Iterator[str]:
            for batch in batches:
                labels.extend(min(1, max(0, one)) for one in batch.column(1).to_pylist())
                yield from batch.column(0).to_pylist()

        model = train(texts(), labels)
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.tobytes()], pa.binary()), pa.array([model.pull.tobytes()], pa.binary()), pa.array([model.bias])], ["weight", "pull", "bias"])

    alone = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("text", "toxic")
    found = common.by_batches(alone, work, "weight binary, pull binary, bias double").collect()  # a row of two floats for every hash row
    if not found:
        return train([], [])
    return Model(np.frombuffer(found[0]["weight"], np.float32), np.frombuffer(found[0]["pull"], np.float32), found[0]["bias"])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Adds score double (0 to 1) and predicted int, under these names, to docs, row by row; columns of the names are replaced.

    A null or empty text has the score of the model's bias. Whole texts are
    read, whatever their length; equal texts have equal scores.
    """
    kept = [name for name in docs.columns if name.lower() not in [one.lower() for one in names]]
    base = docs.select(*(F.col(f"`{name}`") for name in kept))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(batch.column(batch.schema.get_field_index("text")).to_pylist())
            predicted = (scores >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array(predicted)], [*kept, *names])

    schema = T.StructType([*base.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])
    return common.by_batches(base, work, schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every document; learns from labelled rows whose crc32(doc_id) mod 4 is not 2."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    model = fit(docs, labels, common.remainder("doc_id", 4) != 2)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (common.remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
