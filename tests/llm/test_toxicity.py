import numpy as np

from spanloom.llm import common, toxicity
from tests.llm import odd


def auc(labels, scores):
    good, bad = scores[labels == 1], scores[labels == 0]
    return (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean()


def toy(rng, n=600):
    words = ["".join(rng.choice(list("aeioubcdfg"), 5)) for _ in range(300)]
    labels = rng.random(n) < 0.3
    return [" ".join([*rng.choice(words, 30), *(["horrible"] if bad else [])]) for bad in labels], labels.astype(int), words


def test_misspellings_share_vectors():
    rng = np.random.default_rng(1)
    texts, labels, words = toy(rng)
    model = toxicity.train(texts, labels)
    plain = " ".join(words[:30])
    clean, bad, misspelt = model.score([plain, plain + " horrible", plain + " horribble"])
    assert bad > 0.5 > clean and misspelt > clean + 0.05


def test_scores_depend_on_the_text_alone():
    rng = np.random.default_rng(2)
    texts, labels, _ = toy(rng, 200)
    model = toxicity.train(texts, labels)
    together = model.score([*texts[:5], None, "", " \n", odd.LONG, texts[0]])
    assert np.allclose(together[:5], [model.score([t])[0] for t in texts[:5]], rtol=0, atol=1e-12)
    assert together[0] == together[-1] and together[5] == together[6] == together[7]
    assert ((together >= 0) & (together <= 1)).all()


def test_bags_are_small_and_whole():
    texts = [" ".join(f"word{i}x{k}" for k in range(300)) for i in range(40)] + ["", None]
    bags = toxicity._Bags(texts)
    assert sum(counts.nbytes for _, counts, _ in bags.chunks) <= 2 * sum(len(counts) for _, counts, _ in bags.chunks)
    assert sum(int(counts.sum()) for _, counts, _ in bags.chunks) == sum(len(ids) for ids, _ in toxicity.grams(texts))


def test_frames(spark):
    docs = odd.docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 0, 0), (None, 1, 1), (3, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd.clashing(docs, "toxic", "score"), odd.clashing(labels, "text"))
    got = toxicity.score(odd.clashing(docs, "predicted", "toxic"), model)
    assert got.columns == [*docs.columns, "toxic", "score", "predicted"] and got.count() == len(odd.ROWS)
    assert got.where("predicted <> CASE WHEN score >= 0.3 THEN 1 ELSE 0 END").count() == 0
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, blank).collect()} == {0.5}
    assert toxicity.score(odd.empty(spark), model).count() == 0


def test_held_out_rows(spark, sf):
    larger = sf.replace("sf0.001", "sf0.1")
    truth = {r.doc_id: r.toxic for r in common.table(spark, larger, "labels").collect()}
    rows = [r for r in toxicity.op7_toxicity(spark, larger).where("held_out").collect() if r.doc_id in truth]
    assert auc(np.array([truth[r.doc_id] for r in rows]), np.array([r.score for r in rows])) > 0.9


def test_short_texts_have_the_same_grams_alone():
    for text in ("", "a", "hi", "a b", "four", "seven 7"):
        alone = [set(ids.tolist()) for ids, _ in toxicity.grams([text])]
        beside = [set(ids[owner == 0].tolist()) for ids, owner in toxicity.grams([text, "a much longer text"])]
        assert set().union(*alone) == set().union(*beside), text
