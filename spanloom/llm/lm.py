"""Scoring texts with a probabilistic suffix tree, beside a smoothed unigram baseline.

Gathering: texts are packed, a batch of rows to a compressed block, and blocks
are dealt into chunks; scores don't depend on which. Each chunk's distinct byte
7-grams, with their counts in training texts, are dealt by the last three bytes
of their contexts, so that all counts which longer contexts need are together;
there the tree is pruned and smoothed (suffixtree.chances), and every chunk is
answered for its own 7-grams, one bucket of such bytes at a time. Every context
of LEAST_COUNT or more takes part; no machine holds the tree. Only its contexts of up to two bytes (at most 256^3
codes, however large the corpus) reach the driver and are broadcast.

Scoring: each chunk meets its answers. The counts of the most frequent words (at
most HEAD_WORDS) are broadcast; all other words of a text are looked up by a
join with the table of counts, which is never capped.

Null and empty texts have no words and count as the end token alone. Repeated
rows are scored, and learnt from, as often as they occur. Without training
texts all counts are zero and every byte has probability 1/256; an empty table
gives no rows. Whole texts count, however long. Other columns play no part. The
docs are read twice in the same order, so they must come from a stored table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import arrow
from spanloom.llm import common, suffixtree

HEAD_WORDS = 1 << 18
#: Occurrences that a context needs.
LEAST_COUNT = 4
#: Bytes of text in a chunk, about.
CHUNK = 20_000_000
#: Codes that are gathered before they are merged. (A block has at most 256 texts, as an Arrow batch has.)
_PENDING = 1 << 20
#: Bytes of text in a block, but for a single longer text.
BLOCK = 2 << 20
_BUCKET_BITS = 12
#: Words that a task gathers before it hands them on.
_HELD = 400_000


def _whole(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about BLOCK bytes of text."""
    first = size = 0
    for row, n in enumerate(pc.binary_length(batch.column(text)).fill_null(0).to_pylist()):
        if size and size + n > BLOCK:
            yield batch.slice(first, row - first)
            first, size = row, 0
        size += n
    if len(batch) > first:
        yield batch.slice(first)


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary), code, count of the texts (one column): either a word, without the end token, or the code of two bytes and the next one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.nulls(len(held), pa.int64()), pa.array(list(held.values()), pa.int64())], ["word", "code", "count"])
        for batch in (part for batch in batches for part in _whole(batch, batch.schema.names[0])):
            block = suffixtree.block_of([suffixtree.tokens_of(text) for text in batch.column(0).to_pylist()])
            own, n = suffixtree.counted(suffixtree.codes_of_block(block)[0] & np.uint64(0xFFFFFF))
            codes, counts = suffixtree.counted(np.concatenate([codes, own]), np.concatenate([counts, n]))
            words, numbers, _, _ = suffixtree.words_of_block(block)
            held.update({word: n for word, n in zip(words, np.bincount(numbers, minlength=len(words)).tolist()) if n})
            if len(held) >= _HELD:
                yield out()
                held.clear()
        if held:
            yield out()
        yield pa.RecordBatch.from_arrays([pa.nulls(len(codes), pa.binary()), pa.array(codes.view(np.int64)), pa.array(counts)], ["word", "code", "count"])

    return common.by_batches(texts, work, "word binary, code long, count long").groupBy("word", "code").agg(F.sum("count").alias("count"))


def _shallow(found: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """The levels of contexts of up to SHALLOW bytes, from code and count."""
    code, count = found.column("code").to_numpy().view(np.uint64), found.column("count").to_numpy()
    levels = []
    for depth in range(suffixtree.SHALLOW + 1):
        codes, counts = suffixtree.counted(code & np.uint64((1 << (8 * (depth + 1))) - 1), count)
        if depth == suffixtree.SHALLOW:
            _, group = np.unique(codes >> np.uint64(8), return_inverse=True)
            live = np.bincount(group, counts)[group] >= LEAST_COUNT if len(codes) else np.zeros(0, bool)
            codes, counts = codes[live], counts[live]
        levels.append((codes, counts))
    return levels


def _blocks(docs: DataFrame, chunks: int) -> DataFrame:
    """chunk, doc_ids, learnt, block: batches of rows (doc_id, text, learnt); a block has each text's tokens in a line, compressed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        part, press = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3)
        for number, batch in enumerate(part for batch in batches for part in _whole(batch, "text")):
            block = suffixtree.block_of([suffixtree.tokens_of(text) for text in batch.column("text").to_pylist()])
            chunk = int.from_bytes(blake2b(f"{part}:{number}".encode(), digest_size=7).digest(), "big") % chunks
            lists = [pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column(name)) for name in ("doc_id", "learnt")]
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *lists, pa.array([press.compress(block)], pa.binary())], ["chunk", "doc_ids", "learnt", "block"])

    return common.by_batches(docs.select("doc_id", "text", "learnt"), work, "chunk long, doc_ids array<long>, learnt array<boolean>, block binary")


def _lines(chunk: pa.Table) -> Iterator[tuple[list[int | None], list[bool], bytes]]:
    """doc ids, whether they are learnt from, and the texts of each block."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    for row in range(len(chunk)):
        yield chunk.column("doc_ids")[row].as_py(), chunk.column("learnt")[row].as_py(), press.decompress(chunk.column("block")[row].as_py())


class _Merged:
    """Distinct codes and how often they are learnt, merged as they come, so that little more than the distinct ones is held."""

    def __init__(self) -> None:
        self.codes, self.counts, self.pending, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, codes: np.ndarray, learnt: np.ndarray) -> None:
        self.pending.append((codes << np.uint64(1)) | learnt)  # codes have 56 bits
        self.size += len(codes)
        if self.size > _PENDING:
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        marked, n = suffixtree.counted(np.concatenate([*self.pending, np.zeros(0, np.uint64)]))
        n[(marked & np.uint64(1)) == 0] = 0
        self.codes, self.counts = suffixtree.counted(np.concatenate([self.codes, marked >> np.uint64(1)]), np.concatenate([self.counts, n]))
        self.pending, self.size = [], 0
        return self.codes, self.counts


def _packed(codes: np.ndarray) -> bytes:
    """Byte by byte, so that what neighbours share compresses."""
    return codes.view(np.uint8).reshape(-1, 8)[:, :7].T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(7, -1).T
    return out.view(np.uint64).ravel()


def _gather(chunk: pa.Table) -> pa.Table:
    """chunk, bucket, codes, counts of a chunk of texts: all its codes, counted where they are learnt from."""
    merged = _Merged()
    for _, learnt, block in _lines(chunk):
        codes, starts = suffixtree.codes_of_block(block)
        merged.add(suffixtree.turned(codes), np.repeat(np.array(learnt, np.uint64), np.diff(starts)))
    codes, n = merged.all()
    counts = n.astype(np.uint32)
    buckets = codes >> np.uint64(56 - _BUCKET_BITS)
    first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])).tolist()
    spans = list(zip(first, [*first[1:], len(codes)]))
    return pa.table({
        "chunk": pa.array([chunk.column("chunk")[0].as_py()] * len(spans), pa.int64()),
        "bucket": pa.array(buckets[first].astype(np.int32)),
        "codes": pa.array([_packed(codes[a:b]) for a, b in spans], pa.binary()),
        "counts": pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
    })


def answers(texts: DataFrame, levels: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """chunk, bucket, logs (floats of the chunk's distinct turned codes in that bucket, in order), kept.

    texts: chunk, learnt, block. Logs are NaN where no state is deeper
    than SHALLOW; rows without chunk name in kept the suffixes of deeper states.
    """
    common.ship(texts.sparkSession)
    (codes, counts), wide = levels[-1], suffixtree.grow(levels, -np.inf)
    _, group = np.unique(codes >> np.uint64(8), return_inverse=True)
    shared = texts.sparkSession.sparkContext.broadcast((wide, codes, counts / np.bincount(group, counts)[group] if len(codes) else np.zeros(0)))
    least = LEAST_COUNT

    def answered(rows: list[tuple]) -> pa.RecordBatch:
        """A bucket's answers to every chunk, and the suffixes of its states, from (chunk, bucket, codes, counts)."""
        parts = [_unpacked(row[2]) for row in rows]
        ends = np.cumsum([0, *map(len, parts)]).tolist()
        own, back = np.unique(np.concatenate(parts), return_inverse=True)
        del parts
        number = np.bincount(back, np.concatenate([np.frombuffer(row[3], np.uint32) for row in rows]), len(own))
        own = suffixtree.turned_back(own)
        order = np.argsort(own)
        own, number = own[order], number[order]
        wide, near, near_shares = shared.value
        ending, to_ending = np.unique(own & np.uint64(0xFFFFFF), return_inverse=True)
        share = np.ones(len(ending))
        if len(near):
            at = np.minimum(np.searchsorted(near, ending), len(near) - 1)
            share = np.where(near[at] == ending, near_shares[at], 1.0)
        logs, kept = suffixtree.chances(own, number, np.exp(wide._logs(ending))[to_ending], share[to_ending], least)
        placed = np.empty(len(logs), np.float32)
        placed[order] = logs
        placed = placed[back]
        chunks, buckets = [row[0] for row in rows], [row[1] for row in rows]
        data = [placed[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array([*chunks, None], pa.int64()), pa.array([*buckets, None], pa.int32()), pa.array([*data, None], pa.binary()), pa.array([None] * len(rows) + [kept.astype(np.int32)], pa.list_(pa.int32()))],
            ["chunk", "bucket", "logs", "kept"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if rows and row[1] != rows[-1][1]:
                    yield answered(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield answered(rows)

    dealt = texts.select("chunk", "doc_ids", "learnt", "block").groupBy("chunk").applyInArrow(_gather, "chunk long, bucket int, codes binary, counts binary")
    return common.by_batches(dealt.repartition("bucket").sortWithinPartitions("bucket", "chunk"), work, "chunk long, bucket int, logs binary, kept array<int>")


def _head(counts: DataFrame) -> dict[bytes, int]:
    """The most frequent words, at most HEAD_WORDS: all that reach a count which a histogram of counts gives."""
    step = F.floor(F.log2("count") * 8)
    rows = sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda row: -row["step"])  # at most 512 rows
    least, words = None, 0
    for row in rows:
        words += row["n"]
        if words > HEAD_WORDS:
            break
        least = row["step"]
    if least is None:
        return {}
    found = counts.where(step >= least).toArrow()
    return dict(zip(found.column("word").to_pylist(), found.column("count").to_pylist()))


def score(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of docs (doc_id, text).

    training: a condition on doc_id that rows learnt from satisfy.
    """
    learnt = F.coalesce(training, F.lit(False))
    gathered = common.cut(word_counts(docs.where(learnt).select("text")))
    counts = gathered.where("word IS NOT NULL").select("word", "count")
    ends, octets = docs.agg(F.count(F.when(learnt, 1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    row = counts.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    total, distinct = (row["n"] or 0) + ends, row["v"] + (ends > 0)
    levels = _shallow(gathered.where("word IS NULL").select("code", "count").toArrow())
    texts = _blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), learnt.alias("learnt")), octets // CHUNK + 1)
    found = common.cut(answers(texts, levels))
    kept = found.where("chunk IS NULL").select(F.explode("kept").alias("kept")).distinct().toArrow().column("kept").to_numpy()  # at most 65,536
    tree = suffixtree.grow(levels, also=kept.astype(np.uint64))
    size = float(total + distinct + 1)
    head = {word: math.log10((count + 1) / size) for word, count in _head(counts).items()}
    shared = docs.sparkSession.sparkContext.broadcast((head, tree))
    end_log, unknown_log = math.log10((ends + 1) / size), math.log10(1 / size)

    def work(chunk: pa.Table, found: pa.Table) -> pa.Table:
        head, tree = shared.value
        out, blocks, codes, pending = [], [], [np.zeros(0, np.uint64)], 0
        for ids, _, block in _lines(chunk):
            words, numbers, texts, n = suffixtree.words_of_block(block)
            values = np.array([head.get(word, np.nan) for word in words], np.float64)[numbers]
            missing = np.isnan(values)
            total = np.bincount(texts, minlength=n)
            known = total - np.bincount(texts[missing], minlength=n)
            logs = np.bincount(texts, np.where(missing, 0.0, values), n)
            tails, times = suffixtree.counted((texts[missing].astype(np.uint64) << np.uint64(32)) | numbers[missing].astype(np.uint64))
            bounds = np.searchsorted(tails, np.arange(n + 1, dtype=np.uint64) << np.uint64(32)).astype(np.int32)
            tail_words = pa.array([words[number] for number in (tails & np.uint64(0xFFFFFFFF)).tolist()], pa.binary())
            out.append([pa.array(ids, pa.int64()), pa.array(total), pa.array(known), pa.array(logs), pa.ListArray.from_arrays(bounds, tail_words), pa.ListArray.from_arrays(bounds, pa.array(times))])
            found_codes, starts = suffixtree.codes_of_block(block)
            numbers = np.repeat(np.arange(n, dtype=np.uint64), np.diff(starts))
            pairs = np.sort((suffixtree.turned(found_codes) << np.uint64(8)) | numbers)  # codes have 56 bits, a block's texts 8
            ordered = pairs >> np.uint64(8)
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            own = ordered[first]
            blocks.append((own, np.diff(first, append=len(pairs)).astype(np.int32), pairs.astype(np.uint8), n))
            codes, pending = [*codes, own], pending + len(own)
            if pending > _PENDING:
                codes, pending = [suffixtree.distinct(np.concatenate(codes))], 0
        codes = suffixtree.distinct(np.concatenate(codes))
        values = np.frombuffer(b"".join(found.sort_by("bucket").column("logs").to_pylist()), np.float32).astype(np.float64)
        if len(values) != len(codes):
            raise ValueError("the rows of docs changed their order between two readings: docs must be a stored table")
        left = np.flatnonzero(np.isnan(values))
        values[left] = tree._logs(suffixtree.turned_back(codes[left]))
        scores = [np.bincount(of, np.repeat(values[np.searchsorted(codes, own)], times), n) / np.log(10) for own, times, of, n in blocks]
        names = ["doc_id", "n", "known", "logs", "words", "times", "score"]
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([*columns, pa.array(score)], names) for columns, score in zip(out, scores)])

    met_chunks = texts.groupBy("chunk").cogroup(found.where("chunk IS NOT NULL").select("chunk", "bucket", "logs").groupBy("chunk"))
    by_chunk = met_chunks.applyInArrow(work, "doc_id long, n long, known long, logs double, words array<binary>, times array<long>, score double")
    scored = common.cut(by_chunk.withColumn("row", F.monotonically_increasing_id()))
    tails = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("tail")).select("row", "tail.words", "tail.times")
    met = tails.join(counts, F.col("words") == F.col("word"))
    looked_up = met.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10((F.col("count") + 1) / F.lit(size))).alias("more_logs"))
    nothing, zero = F.lit(0), F.lit(0.0)
    return scored.drop("words", "times").join(looked_up, "row", "left").select(
        "doc_id",
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("more", nothing) + (1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", zero) + (F.col("n") - F.col("known") - F.coalesce("more", nothing)) * unknown_log + end_log).alias("base_score"),
        "score",
    )


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every document; learns from those whose crc32(doc_id) mod 7 is not 2."""
    found = score(common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.remainder("doc_id", 7) != 2)
    return found.select("doc_id", (common.remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
