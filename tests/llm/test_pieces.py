import json

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from spanloom.llm import common, pieces
from tests.llm import odd


@pytest.fixture(scope="module")
def codec():
    model, rebuilt = pieces.load(common.tokenizer_file(pieces.MODEL_FILE))
    return pieces.Codec(model, rebuilt)


def unigram(fallback, extra):
    """A small unigram model, written by hand."""
    proto = pb.ModelProto()
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] if fallback else []
    rows += [("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("ab", -4.0, 1), ("▁ab", -4.5, 1), ("ba", -5.0, 1), ("c", -6.0, 1), ("▁cab", -7.0, 1), ("bb", -8.1, 1)]
    for piece, score, kind in rows:
        proto.pieces.add(piece=piece, score=score, type=kind)
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback, proto.trainer_spec.unk_id = 1, fallback, 0
    proto.trainer_spec.vocab_size = len(proto.pieces)
    proto.normalizer_spec.name, proto.normalizer_spec.add_dummy_prefix = "identity", True
    proto.normalizer_spec.remove_extra_whitespaces, proto.normalizer_spec.escape_whitespaces = extra, True
    return proto.SerializeToString()


@pytest.mark.parametrize("fallback", [False, True])
@pytest.mark.parametrize("extra", [False, True])
def test_unigram_parity(fallback, extra):
    model = unigram(fallback, extra)
    own = pieces.Codec(model, pieces.rebuild(model))
    texts = ["ab cab", "abba bab", " a  b ", "cabbage", "é", "", "aabbabab cab c", "x y"]
    assert own.encode(texts) == own.reference.encode(texts)
    assert own.encode(texts[::-1]) == own.reference.encode(texts[::-1])  # of words that were met before
    if fallback:
        assert own.decode(own.encode(["cab é"])) == ["cab é"]


def test_parity_on_whole_documents(spark, sf, codec):
    texts = [r.text for r in common.table(spark, sf, "documents").collect()]
    ids = codec.encode(texts)
    assert ids == codec.reference.encode(texts) and codec.reference.decode(ids) == texts
    assert codec.decode(ids) == texts and all(codec.agrees(texts, ids))
    rows = pieces.op9_sentencepiece(spark, sf).collect()
    assert all(r.parity and r.round_trip for r in rows) and sorted(r.token_ids for r in rows) == sorted(ids)


def test_words_that_are_met_again_and_forgotten(codec, monkeypatch):
    monkeypatch.setattr(pieces, "MAX_WORDS", 20)
    texts = ["  two  blanks ", "a▁b", "▁", "one one one", "", "é😀", "x\u0000y  ", *(f"w{i} w{i % 7}" for i in range(50))]
    for some in (texts, texts[::-1], texts[3:5]):
        assert codec.encode(some) == codec.reference.encode(some)


def test_frequent_words_are_kept(codec, monkeypatch):
    monkeypatch.setattr(pieces, "MAX_WORDS", 40)
    own, asked = pieces.Codec(*pieces.load(common.tokenizer_file(pieces.MODEL_FILE))), []

    class Core:
        def encode_batch_fast(self, texts, **how):
            asked.extend("".join(texts).split(pieces.MARK))
            return codec.core.encode_batch_fast(texts, **how)

    own.core = Core()
    for i in range(30):
        texts = ["the end of it", "", " ".join(f"w{i}x{k}" for k in range(9)) + " the", "é end"]
        assert own.encode(texts) == own.reference.encode(texts)
    assert len(own.number) < 60 and [asked.count(word) for word in ("the", "end", "of", "it", "é", "w3x3")] == [1] * 6


def test_odd_texts_in_a_batch(codec):
    texts = ["", "a\u0000b \u0000", "▁ x", "  two  ", "x\u0000", "é é ▁▁", "the the"]
    for some in (texts, texts[:1], texts[2:4] + texts[5:], texts[::-1], [], ["", ""]):
        flat, ends, back = codec.encoded(some)
        ids = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        assert [one.tolist() for one in ids] == codec.reference.encode(some) and back.all() and codec.agrees(some, ids) == [True] * len(some)


def test_a_difference_is_told(spark, sf, codec, monkeypatch):
    assert codec.agrees(["ab", "ab"], [codec.encode(["ab"])[0], [1, 2]]) == [True, False]
    with pytest.raises(ValueError, match="differs"):
        monkeypatch.setattr(codec, "encode", lambda texts: [[1]] * len(texts))
        codec.probe()


def without(rebuilt, piece):
    """The rebuilt model without the merges that make a piece: texts of this piece get other ids, which decode as before."""
    parts = json.loads(rebuilt)
    parts["model"]["merges"] = [pair for pair in parts["model"]["merges"] if "".join(pair) != piece]
    return json.dumps(parts)


def test_every_text_is_compared(spark, monkeypatch):
    model, rebuilt = pieces.load(common.tokenizer_file(pieces.MODEL_FILE))
    monkeypatch.setattr(pieces, "load", lambda path: (model, without(rebuilt, "▁the")))
    frame = spark.createDataFrame([(i, "see the end" if i % 5 == 3 else "a b") for i in range(40)], "doc_id long, text string").coalesce(1)
    assert {r.doc_id: r.parity for r in pieces.encode(frame).collect()} == {i: i % 5 != 3 for i in range(40)}


def test_round_trip_of_every_word(codec):
    texts = ["one two", "", "two  three", "one é", "a▁b ▁ ", "x\u0000y z"]
    assert codec.encoded(texts)[2].tolist() == [True] * 6
    other = pieces.Codec(*pieces.load(common.tokenizer_file(pieces.MODEL_FILE)))
    other.stands[codec.encode(["two"])[0][0]] = b"other"  # so words are decoded one by one
    other.decode = lambda ids: ["" if back == "two" else back for back in codec.decode(ids)]
    assert other.encoded(texts)[2].tolist() == [False, True, False, True, True, True]
    assert other.encoded(texts[::-1])[2].tolist() == [True, True, True, False, True, False]


def test_splitting_into_words(codec):
    for text in ("a b", " a", "a ", "a  b", "▁", "a\u0000 b", "é 😀 x", ""):
        assert codec._words(codec.normal(text)) == codec.split(codec.normal(text))


def test_unsupported_models():
    proto = pb.ModelProto()
    proto.ParseFromString(unigram(False, False))
    proto.trainer_spec.model_type = 4
    with pytest.raises(ValueError, match="not supported"):
        pieces.rebuild(proto.SerializeToString())


def test_frames(spark, codec):
    frame = odd.clashing(odd.docs(spark), "token_ids", "n_tokens", "meta")
    got = pieces.encode(frame)
    assert got.columns == [*odd.docs(spark).columns, "meta", "token_ids", "n_tokens", "n_byte_tokens", "round_trip", "parity"]
    rows = got.collect()
    reference = sentencepiece.SentencePieceProcessor(model_file=common.tokenizer_file(pieces.MODEL_FILE))
    assert len(rows) == len(odd.ROWS)
    for r in rows:
        ids = reference.encode(r.text or "")
        assert r.token_ids == ids and r.n_tokens == len(ids) and r.n_byte_tokens == sum(map(reference.is_byte, ids)) and r.round_trip and r.parity
    back = pieces.decode(got.select("text", "token_ids"))
    assert all(r.decoded == (r.text or "") for r in back.collect())
    assert pieces.encode(odd.empty(spark)).count() == 0
