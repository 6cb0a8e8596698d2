import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import boosting, pii
from tests.llm import odd


def luhn(digits):
    return sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(digits))) % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(part) <= 255 for part in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
)


def naive(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, pattern, test in RULES for m in re.finditer(pattern, text or "") if test(m.group())]


TEXTS = [
    "a@b.co", "x a@b.com_c@d.org, .e@f.g", "1.2.3.4.5.6.7.8 and 256.1.1.1, 0001.2.3.004", "4111 1111 1111 1111 then 4111-1111-1111-1112", "+1 (555) 010-9999 +12 345 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "é漢字 a@b.co 😀 9.9.9.9", "4111111111111111@x.yz", "12" * 5000, "1 2 " * 3000, "a" * 50_000, "@" * 50, "+" * 50, "..%@a.b-c.d-", "a@b..c a@b.c.", "99999999999999999999.1.1.1",
]


def test_base_rules(spark):
    frame = odd.docs(spark, [(100 + i, text, "en", "a", 1) for i, text in enumerate(TEXTS)])
    got = sorted((r.doc_id or 0, [f"{s.kind}:{s.start}:{s.end}" for s in r.pii_spans if s.base]) for r in pii.scan(odd.clashing(frame, "pii_spans", "kind", "row", "found")).collect())
    assert got == sorted((r[0] or 0, naive(r[1])) for r in [*odd.ROWS, *[(100 + i, t) for i, t in enumerate(TEXTS)]])
    assert pii.scan(odd.empty(spark)).count() == 0


def test_method_adds_spans(spark):
    found = {"mail jane.doe [at] example [dot] com now": "email", "call (415) 555-2671 today": "phone", "ssn 123-45-6789 on file": "ssn", "iban DE89 3704 0044 0532 0130 00 please": "iban"}
    clean = ["on 2024-10-12 we met", "pages 120-135 of it", "version 10.234.567 is out", "meet at noon dot", "order 4111.1111.1111.1112"]
    frame = spark.createDataFrame([(i, text) for i, text in enumerate([*found, *clean])], "doc_id long, text string")
    rows = {r.text: r.pii_spans for r in pii.scan(frame).collect()}
    for text, kind in found.items():
        assert kind in [s.kind for s in rows[text]], text
    for text in clean:
        assert not rows[text], text
    assert all(not (a.start < b.end and b.start < a.end) for spans in rows.values() for a in spans for b in spans if a != b and not (a.base and b.base))


def test_a_dropped_proposal_hides_no_other(spark, monkeypatch):
    from pyspark.sql import functions as F

    class Chain:  # the second proposal of three touches both others
        def column(self, features):
            return F.lit(0.9)

    monkeypatch.setattr(pii, "model", lambda spark: (Chain(), dict.fromkeys(pii.KINDS, 0.5)))
    text = "at DE12 1111 2222 3333 4444 5555 6666 or so"
    rows = pii.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().pii_spans
    spans = sorted((s.start, s.end) for s in rows)
    assert spans and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    proposed = pii._placed(pii._matches(spark.createDataFrame([(1, text)], "row long, text string"), "text", ["row"]), "row").where("kind IS NOT NULL").collect()
    for p in proposed:  # whatever was left out touches something that stayed
        assert any(p.start < b and a < p.end for a, b in spans)


def test_redaction(spark):
    frame = spark.createDataFrame([(1, "to a@b.co!", "x"), (2, None, "x")], "doc_id long, text string, pii_spans string")
    assert [(r.doc_id, r.text, r.pii_spans) for r in pii.redact(frame).orderBy("doc_id").collect()] == [(1, "to ******!", "x"), (2, None, "x")]


def test_trees_as_columns(spark):
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(400, 3))
    labels = (rows[:, 0] * rows[:, 1] > 0).astype(float)
    model = boosting.boost(rows, labels)
    boosting.calibrate(model, rows, labels)
    assert ((model.probability(rows) > 0.5) == labels).mean() > 0.9
    frame = spark.createDataFrame([tuple(map(float, row)) for row in rows], "a double, b double, c double")
    got = [r[0] for r in frame.select(model.column([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == pytest.approx(list(model.probability(rows)))


def test_calibrated_on_unseen_examples(spark):
    trees, limits = pii.model(spark)
    assert set(limits) == set(pii.KINDS) and all(0.5 <= limit <= 2 for limit in limits.values())
    texts = spark.createDataFrame([(i, *row) for i, row in enumerate(pii._examples(seed=99, each=15))], "number long, text string, wanted string, label int")
    rows = pii._matches(texts, "text", ["wanted", "label"]).where("NOT base AND kind = wanted")
    p = trees.column(pii.features(F.col("found"), F.col("kind"), F.col("before"), F.col("after")))
    got = rows.select("label", p.alias("p")).toPandas()
    chosen = got[got.p >= 0.5]
    assert (chosen.label == 1).mean() > 0.9 and (got[got.label == 1].p >= 0.5).mean() > 0.85


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = pii.op3_pii(spark, sf)
    for row in found.collect():
        spans = naive(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s.startswith(kind) for s in spans) for kind, *_ in RULES]
        assert set(spans) <= set(row.spans.split(","))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
