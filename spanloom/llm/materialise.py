"""Training-order materialisation of token ids.

Texts are encoded by a byte-level BPE and packed, each followed by an end
token, into sequences of fixed length. Sequence i of n gets the global slot
P(i), where P is a keyed Feistel permutation of 0 .. n - 1: a network over the
next even number of bits whose results outside the range are walked on until
they fall inside. P needs no shared state, so every task computes its slots
alone, and the same key gives the same order after a restart.

Slots are dealt to shards by range, SEQUENCES_PER_SHARD to a shard, and lie in
a shard in order; partition i of the result is shard i. write_shards() writes a
file for each shard, in which every sequence (little-endian uint16, as base64)
takes stride() bytes, so slot s starts at byte ``(s % SEQUENCES_PER_SHARD) *
stride()`` of its shard, and read_from() resumes from a slot number alone.

Packing goes through the rows of each input partition in their order, so docs
must come from a stored table (cut() otherwise); the tail of a partition is
padded. A null or empty text contributes its end token alone; null ids stay
null in the lists of ids; repeated rows are packed as often as they occur; an
empty table gives no sequences.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import common

RANKS_FILE = "byte_bpe_50k.tiktoken"
#: How the tokenizer of RANKS_FILE splits a text: a fixed value of that public tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
LENGTH = 512
SEQUENCES_PER_SHARD = 4096
KEY = 0x5EED0F0DA7A
ROUNDS = 6

_PACKED = pa.schema([("part", pa.int32()), ("place", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("tokens", pa.binary())])


def _mixed(values: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    values = values + np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def permuted(places: np.ndarray, total: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """The slots of places under the keyed permutation of 0 .. total - 1, or the places of slots."""
    half = np.uint64(max(1, ((total - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _mixed(np.arange(ROUNDS, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(key & (2**64 - 1)))

    def network(values: np.ndarray) -> np.ndarray:
        left, right = values >> half, values & mask
        for k in keys[::-1] if inverse else keys:
            if inverse:
                left, right = right ^ (_mixed(left ^ k) & mask), left
            else:
                left, right = right, left ^ (_mixed(right ^ k) & mask)
        return (left << half) | right

    values = network(np.asarray(places).astype(np.uint64))
    while (outside := values >= np.uint64(total)).any():
        values[outside] = network(values[outside])
    return values.astype(np.int64)


@lru_cache(maxsize=1)
def _encoding(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})


def pack(docs: DataFrame, ranks: bytes, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Sequences of the docs: part and place (their order), n_tokens without padding, doc_ids, tokens (uint16, binary)."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, place = _encoding(shared.value).encode_ordinary, TaskContext.get().partitionId(), 0
        buffer, filled, ids = np.full(length, END, "<u2"), 0, []
        rows: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), _PACKED)], schema=_PACKED)

        for batch in batches:
            for doc_id, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = np.array([*encode(one or ""), END], "<u2")
                at = 0
                while at < len(tokens):
                    taken = min(length - filled, len(tokens) - at)
                    buffer[filled : filled + taken] = tokens[at : at + taken]
                    ids.append(doc_id)
                    filled, at = filled + taken, at + taken
                    if filled == length:
                        rows.append((part, place, filled, ids, buffer.tobytes()))
                        place, filled, ids = place + 1, 0, []
                        if len(rows) >= 1024:
                            yield batch_of(rows)
                            rows = []
        if filled:
            buffer[filled:] = END
            rows.append((part, place, filled, ids, buffer.tobytes()))
        if rows:
            yield batch_of(rows)

    picked = docs.select(F.col("doc_id").cast("long"), text)
    return common.by_batches(picked, work, "part int, place long, n_tokens int, doc_ids array<long>, tokens binary")


def materialise(docs: DataFrame, ranks: bytes, text: str = "text", length: int = LENGTH, per_shard: int = SEQUENCES_PER_SHARD, key: int = KEY) -> DataFrame:
    """One row per slot: slot, shard, place_in_shard, n_tokens, doc_ids, tokens; shards lie whole and in order in a partition.

    The packed sequences are written once, to the shared folder, and counted
    before they are permuted; nothing but one count per partition reaches the
    driver.
    """
    spark = docs.sparkSession
    folder = common.scratch(spark, "packed") + "/sequences"
    pack(docs, ranks, text, length).write.parquet(folder)
    packed = spark.read.schema("part int, place long, n_tokens int, doc_ids array<long>, tokens binary").parquet(folder)
    counts = {row["part"]: row["count"] for row in packed.groupBy("part").count().collect()}
    total, first = 0, {}
    for part in sorted(counts):
        first[part], total = total, total + counts[part]
    shared = spark.sparkContext.broadcast(first)
    names = ["slot", "shard", "place_in_shard", "n_tokens", "doc_ids", "tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = np.array([shared.value[part] for part in batch.column(0).to_pylist()], np.int64)
            slots = permuted(before + batch.column(1).to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array((slots // per_shard).astype(np.int32)), pa.array((slots % per_shard).astype(np.int32)), *batch.columns[2:]], names)

    placed = common.by_batches(packed, work, "slot long, shard int, place_in_shard int, n_tokens int, doc_ids array<long>, tokens binary")
    shards = max(1, -(-total // per_shard))
    return placed.repartitionById(shards, "shard").sortWithinPartitions("slot")  # partition i is the range of shard i


def stride(length: int = LENGTH) -> int:
    """Bytes that a sequence takes in a shard's file: its base64 and a line end."""
    return 4 * -(-2 * length // 3) + 1


def write_shards(materialised: DataFrame, folder: str) -> None:
    """One file a shard, numbered by shard, its sequences in slot order at a fixed stride; on any store that Spark writes to."""
    materialised.select(F.translate(F.base64("tokens"), "\r\n", "")).write.text(folder)


def read_from(spark: SparkSession, folder: str, slot: int = 0, length: int = LENGTH, per_shard: int = SEQUENCES_PER_SHARD) -> DataFrame:
    """slot, tokens from a slot on: earlier shards' files aren't read, and the place in a file follows from the slot alone."""
    wide = stride(length)
    files = spark.read.format("binaryFile").load(folder).withColumn("shard", F.regexp_extract(F.col("path"), r"part-([0-9]+)-", 1).cast("long"))
    files = files.where(F.col("shard") >= slot // per_shard).select("shard", "content")
    places = F.sequence(F.lit(0), (F.length("content") / wide).cast("int") - 1)
    rows = files.where(F.length("content") > 0).select("content", "shard", F.explode(places).alias("place"))
    line = F.substring("content", F.col("place") * wide + 1, F.lit(wide - 1)).cast("string")
    return rows.select((F.col("shard") * per_shard + F.col("place")).alias("slot"), F.unbase64(line).alias("tokens")).where(F.col("slot") >= slot)


def shards(materialised: DataFrame) -> DataFrame:
    """One row per shard: shard, first_slot, n_sequences, payload (the sequences' bytes in slot order, at a fixed stride)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, parts = None, 0, []
        row = lambda: pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([len(parts)], pa.int32()), pa.array([b"".join(parts)], pa.binary())], ["shard", "first_slot", "n_sequences", "payload"])
        for batch in batches:
            for slot, of, tokens in zip(*(column.to_pylist() for column in batch.columns)):
                if of != shard:
                    if parts:
                        yield row()
                    shard, first, parts = of, slot, []
                parts.append(tokens)
        if parts:
            yield row()

    return common.by_batches(materialised.select("slot", "shard", "tokens"), work, "shard int, first_slot long, n_sequences int, payload binary")


def op5_materialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' sequences in training order."""
    with open(common.tokenizer_file(RANKS_FILE), "rb") as file:
        ranks = file.read()
    return materialise(common.table(spark, sf_dir, "documents"), ranks)
