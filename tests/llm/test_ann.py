import numpy as np

from spanloom.llm import ann, common


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, every, k):
    out = {}
    for q, v in rows.items():
        if q % every == 0:
            scored = sorted((-float((w * v).sum()), i) for i, w in rows.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_pigeonhole_is_exact():
    rng = np.random.default_rng(0)
    codes, asked = rng.integers(0, 2**63, (400, 2), dtype=np.uint64), rng.integers(0, 2**63, (30, 2), dtype=np.uint64)
    codes[:50] = asked[0]
    codes[:50, 0] ^= np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64)
    index = ann.Index(codes)
    for radius in (0, 1, 2, 7, 8, 9, 24, 48, 55, 63, 128):
        number, row, probed = index.within(asked, radius)
        expected = np.argwhere(np.bitwise_count(asked[:, None] ^ codes[None, :]).sum(axis=2) <= radius)
        assert sorted(zip(number, row)) == sorted(map(tuple, expected)) and (probed >= np.bincount(number, minlength=30)).all()
    assert index.within(asked, 7)[2].sum() < 200  # of 12,000


def test_clustered_vectors_are_probed_sparsely(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    rows = {i: (centres[i % 40] + 0.05 * rng.normal(size=32)).astype(np.float32).astype(float) for i in range(4000)}
    got, probed, ranked = {}, [], []
    for r in ann.nearest(frame(spark, [(i, [float(x) for x in v], 0) for i, v in rows.items()])).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
        probed.append(r.n_probed)
        ranked.append(r.n_ranked)
    assert np.mean(probed) < 2000 and np.mean(ranked) < 400 and (np.array(ranked) <= probed).all()
    expected = brute(rows, 20, 20)
    assert np.mean([len(got[q] & {i for i, _ in best}) / 20 for q, best in expected.items()]) >= 0.9


def test_several_vectors_of_an_id_and_clashing_columns(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (0, [1.0, 0.0]), (3, [1.0, 1.0]), (4, [3.0])]
    data = spark.createDataFrame([(*row, "v", 9, "b", 7, 1, 2.0) for row in rows], "vec_id long, embedding array<double>, vector string, asker long, block string, part int, rank int, score double")
    got = sorted((r.query_id, r.vec_id, r.score) for r in ann.nearest(data).collect())
    assert got == [(0, 0, 0.0), (0, 0, 0.0), (0, 3, 1.0), (0, 3, 2.0), (0, 4, 0.0), (0, 4, 3.0)]


def test_very_large_components(spark):
    rows = [(i, [1e300 * (1 + i % 3), -1e300, float(i)], 0) for i in range(60)]
    assert ann.nearest(frame(spark, rows).withColumn("embedding", ann.F.col("embedding").cast("array<double>"))).count() >= 0


def test_odd_rows_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    good = {i: np.array([1.0 + (i % 3), float(i % 5), 0.5]) for i in range(60)}  # many equal vectors
    rows = [(i, [float(x) for x in v], 0) for i, v in good.items()]
    odd = [(100, None, 0), (120, [], 0), (140, [0.0, 0.0, 0.0], 0), (160, [1.0, None, 2.0], 0), (180, [nan, 1.0, 1.0], 0), (200, [inf, 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0], 0)]
    got = {}
    for r in ann.nearest(frame(spark, rows + odd + rows[:5])).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    expected = brute(good, 20, 20)
    assert set(got) == set(expected)
    for q, best in expected.items():
        assert [(i, s) for _, i, s in got[q]] == best and [rank for rank, *_ in got[q]] == list(range(1, 21))


def test_few_rows(spark):
    assert ann.nearest(frame(spark, [])).count() == 0
    assert ann.nearest(frame(spark, [(0, [1.0, 2.0], 0)])).count() == 0
    got = ann.nearest(frame(spark, [(0, [1.0, 2.0], 0), (7, [2.0, 1.0], 0), (5, [2.0, 1.0], 0)])).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 5, 4.0), (0, 2, 7, 4.0)]


def test_unequal_norms(spark):
    rng = np.random.default_rng(1)
    rows = {i: rng.normal(size=16).astype(np.float32).astype(float) * (1 + i % 7) for i in range(900)}
    got = {}
    for r in ann.nearest(frame(spark, [(i, [float(x) for x in v], 0) for i, v in rows.items()])).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    expected = brute(rows, 20, 20)
    assert np.mean([len(got[q] & {i for i, _ in best}) / 20 for q, best in expected.items()]) >= 0.9


def test_recall(spark, sf):
    table = common.table(spark, sf.replace("sf0.001", "sf0.1"), "embeddings")
    rows = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    got = {}
    for r in ann.nearest(table).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    expected = brute(rows, 20, 20)
    assert set(got) == set(expected)
    assert np.mean([len(set(got[q]) & {i for i, _ in best}) / 20 for q, best in expected.items()]) >= 0.9
    for q, found in got.items():
        assert all(abs(s - float((rows[q] * rows[i]).sum())) < 1e-12 for i, s in found.items())
