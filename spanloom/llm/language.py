"""Language identification with language-bitmask n-gram filters.

The character n-grams of each language's training texts go to one bit-sliced
Bloom filter: slot h holds a mask with one bit per language, an n-gram sets its
language's bit in HASHES slots, and the bitwise and of its slots returns all
languages that contain it (and some false ones) in one probe. A text's n-grams
are counted per language bit; the counts are corrected by each language's
false-positive rate, which the share of set bits gives; the largest wins.

The filter has a fixed size (1 << SLOT_BITS masks), whatever the corpus. An
empty table gives no rows; without training rows every text is undetermined.
Repeated rows are predicted alike, and learnt from once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from spanloom.llm import common

SLOT_BITS = 20
HASHES = 3
NGRAM = 5
#: Bounds of the training sample: rows and characters of a language, and characters of a text that may be one of them.
ROWS_PER_LANGUAGE = 2_000
CHARS_PER_LANGUAGE = 8_000_000
MAX_TRAINING_CHARS = 100_000
#: N-grams that fewer of a language's training texts have don't enter its filter.
MIN_TEXTS = 3
UNDETERMINED = "und"

_SPACE = 32
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)


def ngrams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams (bytes, within a word and its bordering blanks) of every text's distinct words; whose text each is."""
    parts = [" ".join(["", *dict.fromkeys((text or "").lower().split()), ""]).encode("utf-8", "replace") for text in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(part) for part in parts])
    size = len(data) - NGRAM + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    code = np.zeros(size, np.uint64)
    for k in range(NGRAM):
        code = (code << np.uint64(8)) | data[k : k + size]
    blank = np.concatenate([[0], np.cumsum(data == _SPACE, dtype=np.int32)])
    keep = np.flatnonzero(blank[NGRAM - 1 : NGRAM - 1 + size] == blank[1 : 1 + size])
    return code[keep], owner[keep]


def _slots(code: np.ndarray, k: int) -> np.ndarray:
    mixed = (code ^ (code >> np.uint64(29))) * _FACTORS[k]
    return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


@dataclass
class Model:
    """masks: one array of slots per 64 languages. false_rate: of each language."""

    languages: list[str]
    masks: list[np.ndarray]
    false_rate: np.ndarray
    most_common: str

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and the winner's part of the two largest corrected counts."""
        code, owner = ngrams(texts)
        count = np.bincount(owner, minlength=len(texts)).astype(np.float64)
        slots = [_slots(code, k) for k in range(HASHES)]
        hits = np.zeros((len(texts), len(self.languages)))
        for word, table in enumerate(self.masks):
            mask = table[slots[0]]
            for other in slots[1:]:
                mask &= table[other]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                hits[:, 64 * word + bit] = np.bincount(owner[(mask >> np.uint64(bit)) & np.uint64(1) == 1], minlength=len(texts))
        true = np.maximum(0.0, (hits - count[:, None] * self.false_rate) / np.maximum(1e-9, 1 - self.false_rate))
        names, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            if not self.languages or not text or not any(c.isalpha() for c in text):
                names.append(UNDETERMINED)
                continue
            best = int(true[i].argmax())
            first = true[i, best]
            second = np.delete(true[i], best).max(initial=0.0)
            names.append(self.languages[best] if first > 0 else self.most_common)
            scores[i] = first / (first + second) if first > 0 else 1 / len(self.languages)
        return names, scores


def train(texts: Sequence[str | None], languages: Sequence[str]) -> Model:
    """Fills the filters; languages are in alphabetical order, so ties go to the first."""
    names = sorted(set(languages))
    masks = [np.zeros(1 << SLOT_BITS, np.uint64) for _ in range(-(-len(names) // 64))]
    rates = np.zeros(len(names))
    of = {name: [text for text, one in zip(texts, languages) if one == name] for name in names}
    for i, name in enumerate(names):
        codes, owners = ngrams(of[name])
        seen: list[np.ndarray] = []
        for part in np.split(codes, np.cumsum(np.bincount(owners, minlength=len(of[name])))[:-1]):
            seen.append(np.unique(part))
        grams, count = np.unique(np.concatenate(seen), return_counts=True)
        grams = grams[count >= min(MIN_TEXTS, len(of[name]))]
        bit = np.uint64(1 << (i % 64))
        for k in range(HASHES):
            np.bitwise_or.at(masks[i // 64], _slots(grams, k), bit)
        rates[i] = float(((masks[i // 64] & bit) != 0).mean()) ** HASHES
    common_name = max(names, key=lambda name: len(of[name])) if names else UNDETERMINED
    return Model(names, masks, rates, common_name)


def fit(docs: DataFrame, keep: Column | None = None) -> Model:
    """Learns from text and lang of at most ROWS_PER_LANGUAGE rows and CHARS_PER_LANGUAGE characters of each language, those with the smallest hashes.

    Rows with a null text or lang and texts over MAX_TRAINING_CHARS are not
    learnt from.
    """
    rows = docs if keep is None else docs.where(keep)
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").where(F.length("text") <= MAX_TRAINING_CHARS)
    keyed = rows.select("lang", F.xxhash64("text").alias("hash"))
    share = F.broadcast(keyed.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") > 0))  # a row per language
    drawn = rows.select("lang", "text", F.xxhash64("text").alias("hash")).join(share, "lang")
    drawn = drawn.where(F.pmod("hash", F.lit(1 << 30)) < F.least(F.lit(1.0), F.lit(1.5) * ROWS_PER_LANGUAGE / F.col("n")) * (1 << 30)).dropDuplicates(["lang", "hash"])
    order = Window.partitionBy("lang").orderBy("hash", "text")
    first = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ROWS_PER_LANGUAGE)
    first = first.withColumn("chars", F.sum(F.length("text")).over(order)).where((F.col("chars") <= CHARS_PER_LANGUAGE) | (F.col("rank") == 1))
    found = first.select("text", "lang").collect()
    return train([row["text"] for row in found], [row["lang"] for row in found])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred and score to docs, row by row; columns of these names are replaced.

    A null text, or one without a letter, is UNDETERMINED with score 0, as is
    every text if the model knows no language. Whole texts count.
    """
    kept = [name for name in docs.columns if name.lower() not in ("lang_pred", "score")]
    base = docs.select(*(F.col(f"`{name}`") for name in kept))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], [*kept, "lang_pred", "score"])

    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return common.by_batches(base, work, schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learns from those whose crc32(doc_id) mod 3 is not 1."""
    docs = common.table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs, common.remainder("doc_id", 3) != 1))
    return found.select("doc_id", (common.remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
