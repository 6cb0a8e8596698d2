import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spanloom.llm import common, materialise as m
from tests.llm import odd


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**64 - 1))
def test_permutation(total, key):
    slots = m.permuted(np.arange(total), total, key)
    assert sorted(slots) == list(range(total))
    assert (m.permuted(slots, total, key, inverse=True) == np.arange(total)).all()


def test_key_changes_the_order():
    assert (m.permuted(np.arange(1000), 1000, 1) != m.permuted(np.arange(1000), 1000, 2)).any()


def ranks():
    with open(common.tokenizer_file(m.RANKS_FILE), "rb") as file:
        return file.read()


def test_round_trip(spark):
    docs = odd.clashing(odd.docs(spark), "tokens", "slot")
    got = m.materialise(docs.repartition(3), ranks(), length=64, per_shard=50).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert all(r.shard == r.slot // 50 and r.place_in_shard == r.slot % 50 and len(r.tokens) == 128 for r in got)
    encoding = m._encoding(ranks())
    expected = sorted([*encoding.encode_ordinary(row[1] or ""), m.END] for row in odd.ROWS)
    packed = m.pack(docs.coalesce(1), ranks(), length=64).orderBy("part", "place").collect()
    stream = [int(t) for r in packed for t in np.frombuffer(r.tokens, "<u2")[: r.n_tokens]]
    texts, one = [], []
    for token in stream:
        one.append(token)
        if token == m.END:
            texts, one = [*texts, one], []
    assert sorted(texts) == expected and not one
    assert {i for r in got for i in r.doc_ids} == {row[0] for row in odd.ROWS}
    assert sum(r.n_tokens for r in got) == len(stream)


def test_shards_have_a_fixed_stride(spark):
    frame = m.materialise(odd.docs(spark), ranks(), length=64, per_shard=50)
    by_slot = {r.slot: r.tokens for r in frame.collect()}
    shards = m.shards(frame).collect()
    assert sorted(r.shard for r in shards) == list(range(-(-len(by_slot) // 50)))
    for r in shards:
        assert r.first_slot == 50 * r.shard and len(r.payload) == r.n_sequences * 128
        for i in range(r.n_sequences):
            assert r.payload[i * 128 : (i + 1) * 128] == by_slot[r.first_slot + i]


def test_shard_files_are_read_on_from_a_slot(spark, tmp_path):
    frame = m.materialise(odd.docs(spark), ranks(), length=64, per_shard=50)
    by_slot = {r.slot: bytes(r.tokens) for r in frame.collect()}
    folder = str(tmp_path / "shards")
    m.write_shards(frame, folder)
    files = sorted(p.stat().st_size for p in (tmp_path / "shards").glob("part-*"))
    assert len(files) == -(-len(by_slot) // 50) and all(size % m.stride(64) == 0 for size in files)
    for slot in (0, 49, 50, 123, len(by_slot) - 1):
        assert {r.slot: bytes(r.tokens) for r in m.read_from(spark, folder, slot, 64, 50).collect()} == {k: v for k, v in by_slot.items() if k >= slot}
    assert m.read_from(spark, folder, len(by_slot), 64, 50).count() == 0


def test_same_again(spark, sf):
    twice = [sorted((r.slot, bytes(r.tokens)) for r in m.op5_materialise(spark, sf).collect()) for _ in range(2)]
    assert twice[0] == twice[1] and len(twice[0]) > 100


def test_empty(spark):
    assert m.materialise(odd.empty(spark), ranks()).count() == 0
