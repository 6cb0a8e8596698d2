import math
import re
import zlib
from collections import Counter

import numpy as np

from spanloom.llm import common, lm, suffixtree
from tests.llm import odd

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def naive(rows, learnt):
    counts = Counter(w for i, text in rows if learnt(i) for w in [*words(text), "\n"])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = [*words(text), "\n"]
        out.append((i, len(own), sum(counts[w] > 0 for w in own), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)))
    return out


def check(got, expected):
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    for a, b in zip(got, sorted(expected, key=str), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-9)


def remainder(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


def test_base_on_odd_rows(spark):
    frame = odd.clashing(odd.docs(spark, [(9, "É WORDS here x words", "en", "a", 1)]), "score", "row", "word", "count")
    rows = lm.score(frame, common.remainder("doc_id", 7) != 2).collect()
    check(rows, naive([(r.doc_id, r.text) for r in frame.collect()], lambda i: remainder(i) != 2))
    assert all(r.score < 0 for r in rows)


def test_tail_words_are_looked_up(spark, sf, monkeypatch):
    docs = common.table(spark, sf, "documents")
    monkeypatch.setattr(lm, "HEAD_WORDS", 50)
    check(lm.op10_suffix_tree(spark, sf).collect(), naive([(r.doc_id, r.text) for r in docs.collect()], lambda i: remainder(i) != 2))


def test_nothing_to_learn_from(spark):
    rows = lm.score(odd.docs(spark), common.remainder("doc_id", 7) > 9).collect()
    assert {r.train_tokens for r in rows} == {0} and {r.n_known for r in rows} == {0}
    blank = [r.score for r in rows if r.doc_id == 2]
    assert np.allclose(blank, -math.log10(256))
    assert lm.score(odd.empty(spark), common.remainder("doc_id", 7) != 2).count() == 0


def levels(texts, least=1):
    codes, counts = suffixtree.counted(suffixtree.codes_of([suffixtree.tokens_of(t) for t in texts])[0])
    out = []
    for depth in range(suffixtree.DEPTH + 1):
        own, n = suffixtree.counted(codes & np.uint64((1 << (8 * (depth + 1))) - 1), counts)
        _, group = np.unique(own >> np.uint64(8), return_inverse=True)
        live = np.bincount(group, n)[group] >= least
        out.append((own[live], n[live]))
    return out


def code(context, symbol):
    value = 0
    for byte in (bytes([suffixtree.END]) * suffixtree.DEPTH + context)[-suffixtree.DEPTH :] + bytes([symbol]):
        value = (value << 8) | byte
    return value


def test_distributions_sum_to_one():
    model = suffixtree.grow(levels(["the cat sat on the mat", "the dog sat"] * 20), 2.0)
    for context in (b"", b"the ", b"zzz", b"t", b"\xff\xff"):
        logs = model._logs(np.array([code(context, s) for s in range(256)], np.uint64))
        assert abs(np.exp(logs).sum() - 1) < 1e-6


def test_states_are_closed_under_suffixes_and_follow_divergence():
    texts = ["ab" * 40, "xyxyxy xyx"] * 10
    loose, strict = suffixtree.grow(levels(texts), 0.1), suffixtree.grow(levels(texts), 1e9)
    assert len(strict.state_keys) == 1 < len(loose.state_keys)  # the root alone
    tag = np.uint64(1 << 63)
    states = {(int(key ^ tag) >> 56) - 1: set() for key in loose.state_keys}
    for key in loose.state_keys:
        states[(int(key ^ tag) >> 56) - 1].add(int(key ^ tag) & ((1 << 56) - 1))
    for depth in range(max(states), 0, -1):
        assert {s & ((1 << (8 * (depth - 1))) - 1) for s in states.get(depth, ())} <= states[depth - 1]


def brute(model, texts):
    """Each byte by a walk down from its longest suffix state, with dictionaries."""
    seen, states = dict(zip(model.seen_keys.tolist(), model.seen_logs.tolist())), dict(zip(model.state_keys.tolist(), model.state_logs.tolist()))
    out = []
    for text in texts:
        data = bytes([suffixtree.END]) * suffixtree.DEPTH + b" ".join(suffixtree.tokens_of(text)) + bytes([suffixtree.END])
        total = 0.0
        for at in range(suffixtree.DEPTH, len(data)):
            depth, spared = next(d for d in range(suffixtree.DEPTH, -1, -1) if (int.from_bytes(data[at - d : at], "big") | (d + 1) << 56 | 1 << 63) in states), 0.0
            while depth >= 0:
                key = int.from_bytes(data[at - depth : at + 1], "big") | (depth + 2) << 56
                if key in seen:
                    total += seen[key] + spared
                    break
                spared += states[int.from_bytes(data[at - depth : at], "big") | (depth + 1) << 56 | 1 << 63]
                depth -= 1
            else:
                total += spared - math.log(256)
        out.append(total / math.log(10))
    return out


def test_scores_against_a_walk():
    texts = ["The cat sat on the mat", "a dog", "", None, "zebra ÿ the cat", "the the the mat"]
    model = suffixtree.grow(levels(["the cat sat on the mat", "the dog sat on a cat"] * 15, 2), 1.0)
    got = model.score([suffixtree.tokens_of(t) for t in texts])
    assert np.allclose(got, brute(model, texts), atol=1e-4)
    assert np.allclose(got, [model.score([suffixtree.tokens_of(t)])[0] for t in texts])


def test_tree_of_all_frequent_contexts_dealt_over_partitions(spark, monkeypatch):
    rare = "quixotic zephyr jumbled vexing sphinxes"  # under 2e-6 of all bytes, four times
    texts = ["the cat sat on the mat and the dog sat on a log"] * 100 + ["alpha beta gamma delta " * 2500] * 40 + [rare] * 4
    rows = [(i, text) for i, text in enumerate(texts)] + [(1000, rare), (1001, "zephyr ÿ the cat"), (1002, ""), (1003, None)]
    assert 2e-6 * sum(len(t) for t in texts) > lm.LEAST_COUNT
    monkeypatch.setattr(lm, "CHUNK", 400_000)
    from pyspark.sql import functions as F

    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 1000).collect()}
    model = suffixtree.grow(levels(texts, lm.LEAST_COUNT))
    expected = model.score([suffixtree.tokens_of(t) for _, t in rows])
    assert np.allclose([got[i] for i, _ in rows], expected, rtol=1e-5, atol=1e-4)


def test_better_than_the_baseline_on_held_out_texts(spark, sf):
    rows = lm.op10_suffix_tree(spark, sf.replace("sf0.001", "sf0.1")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
