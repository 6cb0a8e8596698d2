import hashlib
import re

from pyspark.sql import functions as F

from spanloom.llm import decontamination as d
from tests import oracle
from tests.llm import odd

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def naive(text, items):
    doc, hit, found = words(text), set(), set()
    for item, other in items:
        own = words(other)
        size = min(len(own), d.WINDOW)
        for i in range(len(own) - size + 1) if own and item is not None else ():
            for j in range(len(doc) - size + 1):
                if doc[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(doc), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(doc)


ITEMS = [(1, ITEM), (2, "Short item"), (10, "one"), (3, None), (None, "plain words here"), (4, ""), (5, ITEM.upper() + " more"), (6, "short item")]


def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_against_brute_force(spark):
    more = [(20, f"x {ITEM}, y", "en", "a", 1), (21, " ".join(ITEM.split()[:12]), "en", "a", 1), (22, "a short  ITEM and one", "en", "a", 1), (23, "filler " * 300 + ITEM, "en", "a", 1), (24, ITEM + " " + ITEM, "en", "a", 1)]
    frame = odd.docs(spark, more)
    got = sorted((r.doc_id or 0, r.text or "", r.n_words, r.n_hit, r.items, r.contaminated) for r in d.scan(odd.clashing(frame, "items", "hash", "row"), bench(spark)).collect())
    expected = sorted((r[0] or 0, r[1] or "", *naive(r[1], ITEMS)) for r in [*odd.ROWS, *more])
    assert got == expected


def test_empty_tables(spark):
    assert d.scan(odd.empty(spark), bench(spark)).count() == 0
    got = d.scan(odd.docs(spark), bench(spark).limit(0))
    assert got.count() == len(odd.ROWS) and got.where("contaminated").count() == 0


def test_shuffled_set(spark, monkeypatch):
    frame = odd.docs(spark, [(20, f"x {ITEM}, y", "en", "a", 1)])
    broadcast = sorted(map(str, d.scan(frame, bench(spark)).collect()))
    monkeypatch.setattr(d, "MAX_BROADCAST_WINDOWS", 0)
    assert sorted(map(str, d.scan(frame, bench(spark)).collect())) == broadcast


def test_removal(spark):
    frame = odd.docs(spark, [(20, ITEM, "en", "a", 1), (23, "Filler, " * 300 + ITEM + "! End.", "en", "a", 1)])
    only = bench(spark).where("item_id = 1")
    kept = {r.doc_id: r.text for r in d.decontaminate(frame, only).collect()}
    assert 20 not in kept and kept[23] == "Filler, " * 300 + " " * 14 + "! End."
    assert d.decontaminate(frame, only).columns == frame.columns and kept[5] == odd.LONG


def test_removal_after_capitals(spark):
    before = "USA, I own an iPhone; A McDonald is HERE. NASA and É.U. " * 40
    frame = odd.docs(spark, [(20, before + ITEM.title() + "! The END.", "en", "a", 1), (21, "I " * 300 + ITEM.upper() + " I", "en", "a", 1)])
    kept = {r.doc_id: r.text for r in d.decontaminate(frame, bench(spark).where("item_id = 1")).collect()}
    assert kept[20] == before + " " * 14 + "! The END." and kept[21] == "I " * 300 + " " * 14 + " I"


def test_no_python_in_the_plan(spark, sf):
    plan = d.op2_decontamination(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_query(spark, sf):
    oracle.same(oracle.connection(sf), d.ORACLE_SQL, d.op2_decontamination(spark, sf))
    row = d.op2_decontamination(spark, sf).where("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_removal_leaves_no_window_over_a_seam(spark):
    item, many = ITEM.split()[:13], "filler " * 900
    once = " ".join([*item[:5], ITEM, *item[5:]])
    nested = " ".join([*item[:7], *item[:2], *item[:11], *item, *item[11:], *item[2:], *item[7:]])
    rows = [(20, f"{many}{once} end", "en", "a", 1), (21, f"{many}{nested} end", "en", "a", 1), (22, f"{many}a short Short item item end", "en", "a", 1), (23, many, "en", "a", 1), (24, None, "en", "a", 1)]
    got = d.decontaminate(spark.createDataFrame(rows, odd.SCHEMA), bench(spark).where("item_id IN (1, 2)")).collect()
    kept, items = {r.doc_id: r.text for r in got}, [one for one in ITEMS if one[0] in (1, 2)]
    assert len(got) == len(rows) and all(naive(text, items)[1] == 0 for text in kept.values())
    assert [kept[i].split() for i in (20, 21, 22)] == [[*many.split(), *end] for end in (["end"], ["end"], ["a", "end"])]
    assert kept[23] == many and kept[24] is None
