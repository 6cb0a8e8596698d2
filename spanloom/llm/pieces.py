"""SentencePiece models on the tokenizers library.

A model file's protobuf is parsed and rebuilt as a tokenizers pipeline: its
normaliser (compiled character map, white-space rules, metaspace marker), its
pieces (unigram scores, or BPE merges ranked by score) and byte fallback. The
rebuilt tokenizer must give the ids of the sentencepiece library on a probe of
every piece and of awkward texts before it is used (a difference raises).
Encoding and decoding take batches, on THREADS threads.

Where no piece of a model crosses the start of a word, a batch's texts are split
into words and every distinct word is encoded, and its ids decoded, once;
otherwise whole texts are. A worker keeps the words that most batches had. A text
makes the round trip if all its words do. Every whole text is encoded, and its
ids decoded, by the sentencepiece library as well. A difference is told in the
column parity; it ends nothing.

Null and empty texts have no ids and decode to an empty text. Whole texts are
encoded, however long. Each row is encoded by itself: repeated rows repeat, an
empty table gives no rows. Columns that the operator adds replace those of the
same name.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import common

MARK = "▁"
MODEL_FILE = "piece_bpe_32k.model"
#: Threads of a batch's encoding and decoding, if a task hasn't more cores; distinct words that a worker keeps.
THREADS = 2
MAX_WORDS = 150_000

_WORD = f"{MARK}*[^{MARK}]+|{MARK}+"
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_UNIGRAM, _BPE = 1, 2
_PROBES = ("", " ", "  a  b ", "a▁b", "▁▁x ", "é　é\U0001f600\tq\n\nz", "x\u0000y", "<s></s><unk><0x41>", "1234567890" * 9, "ab" * 300)


def _proto(model: bytes):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return proto


def rebuild(model: bytes) -> str:
    """The tokenizers pipeline of a SentencePiece model, as JSON. Unigram and BPE models are supported; others raise."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    proto = _proto(model)
    pieces, trainer, rules = list(proto.pieces), proto.trainer_spec, proto.normalizer_spec
    fallback = bool(trainer.byte_fallback)
    unknown = next(i for i, piece in enumerate(pieces) if piece.type == _UNKNOWN)
    if trainer.treat_whitespace_as_suffix or not rules.escape_whitespaces:
        raise ValueError("models with a trailing or no metaspace marker are not supported")
    if trainer.model_type == _UNIGRAM:
        rows = [(piece.piece, piece.score if piece.type in (_NORMAL, _USER) else -1e9 if piece.type != _BYTE else -1e6) for piece in pieces]
        core = models.Unigram(rows, unknown, fallback)
    elif trainer.model_type == _BPE:
        ids = {piece.piece: i for i, piece in enumerate(pieces)}
        made = {piece.piece for piece in pieces if piece.type in (_NORMAL, _USER)}
        merges = []
        for i, piece in enumerate(pieces):
            if piece.type == _NORMAL:
                halves = ((piece.piece[:k], piece.piece[k:]) for k in range(1, len(piece.piece)))
                merges += [(-piece.score, i, len(a), a, b) for a, b in halves if a in made and b in made]
        merges.sort(key=lambda row: row[:3])
        core = models.BPE(vocab=ids, merges=[(a, b) for *_, a, b in merges], unk_token=pieces[unknown].piece, fuse_unk=True, byte_fallback=fallback)
    else:
        raise ValueError(f"model type {trainer.model_type} is not supported")
    steps = [normalizers.Precompiled(bytes(rules.precompiled_charsmap))] if rules.precompiled_charsmap else []
    if rules.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if rules.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer = Tokenizer(core)
    tokenizer.normalizer = normalizers.Sequence(steps)
    if all(MARK not in piece.piece.lstrip(MARK) for piece in pieces):  # no piece crosses the start of a word
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(_WORD), "isolated")
    tail = [decoders.Strip(" ", 1, 0)] if rules.add_dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return tokenizer.to_str()


def _keys(words: pa.Array) -> list[bytes]:
    return words.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()


class Codec:
    """Encodes and decodes batches of texts with a rebuilt model, and compares with the sentencepiece library."""

    def __init__(self, model: bytes, rebuilt: str, threads: int = 1) -> None:
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(rebuilt)
        parts = json.loads(rebuilt)
        self.by_words = parts["pre_tokenizer"] is not None
        self.split = re.compile(_WORD if self.by_words else "(?s).+").findall
        self.core = Tokenizer.from_str(json.dumps(parts | {"normalizer": None}))
        self.threads = threads
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = _proto(model)
        rules = proto.normalizer_spec
        self.prefix = MARK if rules.add_dummy_prefix else ""
        self.rules = bool(rules.remove_extra_whitespaces or rules.precompiled_charsmap)
        self.bytes = np.array([piece.type == _BYTE for piece in proto.pieces])
        #: Bytes of text that a piece stands for, and how many, where every piece stands for those it has.
        self.stands = [bytes([int(piece.piece[1:-1], 16)]) if piece.type == _BYTE else piece.piece.encode() for piece in proto.pieces]
        self.width = np.array(list(map(len, self.stands))) if proto.trainer_spec.byte_fallback else None
        #: Words that were met: their numbers, where their ids begin, whether these decode to them, how many batches had them.
        self.number: dict[bytes, int] = {}
        self.ids, self.starts, self.back, self.met = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def _thin(self) -> None:
        """Keeps the half of the words that most batches had, in their order, and halves how many those were."""
        kept = np.sort(np.argsort(-self.met, kind="stable")[: len(self.met) // 2])
        words, size = list(self.number), np.diff(self.starts)
        self.ids = self.ids[np.repeat(np.isin(np.arange(len(words)), kept), size)]
        self.starts = np.concatenate([[0], np.cumsum(size[kept])])
        self.back, self.met = self.back[kept], self.met[kept] // 2
        self.number = {words[i]: place for place, i in enumerate(kept.tolist())}

    def normal(self, text: str) -> str:
        if self.rules:
            return self.tokenizer.normalizer.normalize_str(text)
        return self.prefix + text.replace(" ", MARK) if text else ""

    def plain(self, text: str) -> str:
        """The text as a round trip gives it: normalised by the model's rules, markers read as blanks."""
        return self.read(self.normal(text)) if self.rules else text.replace(MARK, " ")

    def read(self, normal: str) -> str:
        return normal.removeprefix(self.prefix).replace(MARK, " ")

    def _cut(self, normal: str) -> str:
        """The words of a text without NUL, joined by NUL."""
        if self.by_words and normal[:1] == MARK and MARK * 2 not in normal:  # the same without a pattern
            return normal.replace(MARK, "\0" + MARK)[1:]
        return "\0".join(self.split(normal))

    def _words(self, normal: str) -> list[str]:
        return self._cut(normal).split("\0") if normal and "\0" not in normal else self.split(normal)

    def _parts(self, normals: Sequence[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct words of texts; for each word of each text, its place among them; how many words each text has."""
        if any("\0" in one for one in normals):
            lists = pa.array([self._words(one) for one in normals], pa.large_list(pa.large_string()))
        else:
            lists = pc.split_pattern(pa.array([self._cut(one) or None for one in normals], pa.large_string()), "\0")
        coded = lists.flatten().dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(), lists.value_lengths().fill_null(0).to_numpy()

    def _joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words that begin with the marker and end without, encoded as a few long texts; how many ids each has; whether they decode to it."""
        wanted = np.cumsum(pc.binary_length(words).to_numpy())
        begins = int(np.frombuffer(words.buffers()[1], np.int64)[words.offset])
        whole = words.buffers()[2].slice(begins, int(wanted[-1])).to_pybytes()
        step = -(-len(words) // (4 * self.threads))
        cuts = [0, *wanted[step - 1 : -1 : step].tolist(), len(whole)]
        long = [whole[a:b].decode() for a, b in zip(cuts, cuts[1:])]
        ids = np.concatenate([np.array(one.ids, np.int32) for one in self.core.encode_batch_fast(long, add_special_tokens=False)])
        reach = np.cumsum(self.width[ids])
        ends = np.searchsorted(reach, wanted) + 1
        size = np.diff(ends, prepend=0)
        if b"".join(map(self.stands.__getitem__, ids.tolist())) == whole and np.array_equal(reach[ends - 1], wanted):  # each word's pieces stand for its bytes, so they decode to it
            return ids, size, np.ones(len(words), bool)
        return ids, size, self._back(words.to_pylist(), [ids[a:b].tolist() for a, b in zip(ends - size, ends)])

    def _back(self, words: list[str], ids: list[list[int]]) -> np.ndarray:
        """For each word, whether its ids decode to it."""
        return np.fromiter((back == self.read(word) for back, word in zip(self.decode(ids), words)), bool)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Encodes words that weren't met before; gives their numbers."""
        plain = np.zeros(len(words), bool)
        if self.by_words and self.width is not None:
            plain = pc.and_not(pc.starts_with(words, MARK), pc.ends_with(words, MARK)).to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        numbers = np.empty(len(words), np.int64)
        numbers[order] = np.arange(len(self.number), len(self.number) + len(words))
        words = words if plain.all() else words.take(pa.array(order))
        parts = [self._joined(words[: int(plain.sum())])] if plain.any() else []
        if not plain.all():
            other = words[int(plain.sum()) :].to_pylist()
            found = [one.ids for one in self.core.encode_batch_fast(other, add_special_tokens=False)]
            parts.append((np.fromiter(chain.from_iterable(found), np.int32), np.array([len(one) for one in found]), self._back(other, found)))
        self.number.update(zip(_keys(words), range(len(self.number), len(self.number) + len(words))))
        self.ids = np.concatenate([self.ids, *(ids for ids, _, _ in parts)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate([size for _, size, _ in parts]))])
        self.back = np.concatenate([self.back, *(back for _, _, back in parts)])
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int64)])
        return numbers

    def encoded(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the texts; where each text's ids begin (and the last's end); for each text, whether its ids decode to it."""
        if len(self.number) > MAX_WORDS:
            self._thin()
        words, which, many = self._parts([self.normal(text) for text in texts])
        known = np.fromiter(map(self.number.get, _keys(words), repeat(-1)), np.int64, len(words))
        if len(new := np.flatnonzero(known < 0)):
            known[new] = self._learn(words.take(pa.array(new)))
        self.met[known] += 1
        numbers = known[which]
        first, size = self.starts[numbers], np.diff(self.starts)[numbers]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])]
        places = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
        wrong = np.concatenate([[0], np.cumsum(~self.back[numbers])])
        return flat, ends[places], wrong[places[1:]] == wrong[places[:-1]]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        flat, places, _ = self.encoded(texts)
        return [flat[a:b].tolist() for a, b in zip(places[:-1], places[1:])]

    def decode(self, ids: Sequence[Sequence[int]]) -> list[str]:
        return self.tokenizer.decode_batch(list(ids), skip_special_tokens=False)

    def agrees(self, texts: Sequence[str], ids: Sequence[Sequence[int]]) -> list[bool]:
        """For each text, whether the sentencepiece library gives these ids, and for the ids the text."""
        expected = (self.reference.encode(text, return_type="numpy") for text in texts)  # one at a time, which holds and costs less than a batch
        back = self.reference.decode([np.asarray(one, np.int32) for one in ids], num_threads=1)
        return [np.array_equal(want, got) and one == self.plain(text) for want, got, one, text in zip(expected, ids, back, texts)]

    def probe(self) -> None:
        texts = [*_PROBES, *(self.reference.id_to_piece(i).replace(MARK, " ") for i in range(self.reference.get_piece_size()))]
        for whole in (self.encode(texts), [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]):
            for text, expected, got in zip(texts, self.reference.encode(texts, num_threads=1), whole):
                if expected != got:
                    raise ValueError(f"the rebuilt tokenizer differs from sentencepiece on {text[:80]!r}")


@lru_cache(maxsize=2)
def _codec(model: bytes, rebuilt: str, threads: int) -> Codec:
    return Codec(model, rebuilt, threads)


def load(path: str) -> tuple[bytes, str]:
    """A model file's bytes and its verified rebuilt form; read on the driver, so executors need no such file."""
    with open(path, "rb") as file:
        model = file.read()
    rebuilt = rebuild(model)
    _codec(model, rebuilt, 1).probe()
    return model, rebuilt


def encode(docs: DataFrame, path: str | None = None, text: str = "text", threads: int | None = None) -> DataFrame:
    """Adds token_ids array<int>, n_tokens, n_byte_tokens (of byte fallback), round_trip, parity to docs.

    round_trip: decoding the ids gives the text again, with the marker character
    read as a blank and the model's white-space rules applied (null: an empty
    text). parity: the sentencepiece library gave the same ids for the whole
    text, and the text for the ids. Columns of these names are replaced.
    """
    added = ["token_ids", "n_tokens", "n_byte_tokens", "round_trip", "parity"]
    kept = [name for name in docs.columns if name.lower() not in added]
    base = docs.select(*(F.col(f"`{name}`") for name in kept))
    context = docs.sparkSession.sparkContext
    threads = threads or max(THREADS, int(context.getConf().get("spark.task.cpus", "1")))
    shared = context.broadcast(load(path or common.tokenizer_file(MODEL_FILE)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value, threads)
        for batch in batches:
            texts = [one or "" for one in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            flat, ends, back = codec.encoded(texts)
            same = codec.agrees(texts, [flat[a:b] for a, b in zip(ends[:-1], ends[1:])])
            wide = np.concatenate([[0], np.cumsum(codec.bytes[flat])])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends.astype(np.int32), flat), pa.array(np.diff(ends)), pa.array(wide[ends[1:]] - wide[ends[:-1]], pa.int64()), pa.array(back, pa.bool_()), pa.array(same, pa.bool_())],
                [*kept, *added],
            )

    fields = [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("n_byte_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType()), T.StructField("parity", T.BooleanType())]
    return common.by_batches(base, work, T.StructType([*base.schema.fields, *fields]))


def decode(frame: DataFrame, path: str | None = None, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Adds the text of an array of ids; null ids give an empty text, a column of that name is replaced."""
    kept = [name for name in frame.columns if name.lower() != out.lower()]
    base = frame.select(*(F.col(f"`{name}`") for name in kept))
    shared = frame.sparkSession.sparkContext.broadcast(load(path or common.tokenizer_file(MODEL_FILE)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value, THREADS)
        for batch in batches:
            rows = [one or [] for one in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codec.decode(rows), pa.string())], [*kept, out])

    return common.by_batches(base, work, T.StructType([*base.schema.fields, T.StructField(out, T.StringType())]))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids under the 32,000-piece model, with the outcome of round trip and comparison."""
    return encode(common.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
