import numpy as np

from spanloom.llm import common, language
from tests.llm import odd

EN, FR = "the quick brown fox jumps over the lazy dog and runs away", "le renard brun saute par dessus le chien paresseux et court"


def model():
    return language.train([EN, FR] * 5, ["en", "fr"] * 5)


def test_decisions():
    names, scores = model().predict([EN, FR, None, "", "123 !?", "qqqqqq", "the fox and the dog"])
    assert names == ["en", "fr", "und", "und", "und", "en", "en"]
    assert (scores >= 0).all() and (scores <= 1).all() and list(scores[2:5]) == [0, 0, 0]


def test_filter_returns_every_language_of_an_ngram():
    trained = model()
    for name, text in (("en", EN), ("fr", FR)):
        code, _ = language.ngrams([text])
        mask = trained.masks[0][language._slots(code, 0)]
        for k in range(1, language.HASHES):
            mask &= trained.masks[0][language._slots(code, k)]
        bit = np.uint64(1 << trained.languages.index(name))
        assert ((mask & bit) != 0).all()


def test_more_than_64_languages():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 9)) for _ in range(70)]
    trained = language.train(words, [f"l{i:02d}" for i in range(70)])
    assert len(trained.masks) == 2 and trained.predict(words)[0] == [f"l{i:02d}" for i in range(70)]


def test_frames(spark):
    frame = odd.clashing(odd.docs(spark), "score", "lang_pred", "rank", "n")
    got = language.identify(frame, language.fit(frame))
    assert got.columns == [*odd.docs(spark).columns, "rank", "n", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(odd.ROWS) and all(r.lang_pred == "und" for r in rows if not r.text or not any(c.isalpha() for c in r.text))
    nothing = language.fit(odd.empty(spark))
    assert {r.lang_pred for r in language.identify(frame, nothing).collect()} == {"und"}
    assert language.identify(odd.empty(spark), model()).count() == 0


def test_held_out_accuracy(spark, sf):
    larger = sf.replace("sf0.001", "sf0.01")
    truth = {r.doc_id: r.lang for r in common.table(spark, larger, "documents").collect()}
    rows = language.op4_language(spark, larger).where("held_out").collect()
    assert len(rows) > 200 and np.mean([truth[r.doc_id] == r.lang_pred for r in rows]) > 0.98
