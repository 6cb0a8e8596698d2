"""Personal data by candidate spans and boosted trees, with DataFrame functions only.

Four base rules find e-mail and IP addresses, card and phone numbers by their
exact formats. Beside them, generators of high recall propose overlapping spans
of looser formats; every proposal gets format and context features, boosted
trees (boosting.py, compiled to one expression) give its calibrated
probability, and those over their kind's threshold are added, the likeliest
first, unless they touch a base span or one that was added before. The trees are trained, when first needed, on
examples that this module writes from templates; their features come from the
same expressions as those of the documents.

Offsets are code points, end exclusive. They come from the texts between
matches, which a split by the same pattern gives; patterns are possessive where
a match can't need to give anything back, so long texts neither overflow the
matcher's stack nor take quadratic time.

A null text has no spans, like an empty one. Every row stays one row; repeated
rows repeat, and columns outside the result play no part; an empty table gives
no rows. Proposals of equal probability are taken by kind, then by place.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.llm import boosting, common

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban")
#: Share of proposals over a threshold that are personal data, on examples that training and calibration didn't see.
PRECISION = 0.98

_LOCAL = r"A-Za-z0-9._%+-"
#: Base rules: kind, what a text must hold to be searched, pattern.
_BASE = (
    ("email", "@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"),
    ("card", r"[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
#: Generators, alike.
_LOOSE = (
    ("email", r"(?i)[\[({] ?at ?[\])}]| at [a-z0-9.-]{1,63} dot ", r"(?i)[a-z0-9._%+-]{1,64}(?: ?[\[({] ?(?:at|@) ?[\])}] ?| at )[a-z0-9-]{1,63}(?:(?: ?[\[({] ?(?:dot|\.) ?[\])}] ?| dot |\.)[a-z0-9-]{1,63}){1,5}"),
    ("ip", r"[0-9a-fA-F]:[0-9a-fA-F]|[0-9] ?[\[(]\.", r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?: ?[\[(]\.[\])] ?[0-9]{1,3}){3})(?![0-9A-Za-z:])"),
    ("card", r"[0-9]{4}[._/ -]{1,3}[0-9]", r"(?<![0-9A-Za-z])[0-9](?:[\x20._/-]{0,3}[0-9]){12,18}(?![0-9A-Za-z])"),
    ("phone", r"[0-9]{2}\)?[\x20./-]{1,2}[0-9]{2}", r"(?<![0-9A-Za-z+])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z])"),
    ("ssn", r"[0-9]{3}[-. ][0-9]{2}[-. ][0-9]{4}", r"(?<![0-9A-Za-z-])[0-9]{3}[-\x20.][0-9]{2}[-\x20.][0-9]{4}(?![0-9A-Za-z-])"),
    ("iban", r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
)
_BEFORE, _AFTER = 32, 8


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(backwards, i, F.lit(1)).cast("int")).otherwise((F.substring(backwards, i, F.lit(1)).cast("int") * 2).cast("int") - F.when(F.substring(backwards, i, F.lit(1)).cast("int") >= 5, 9).otherwise(0)),
    )
    return (F.length(digits) > 0) & (total % 10 == 0)


def _valid(kind: Column, found: Column) -> Column:
    """What a base rule asks of a match beyond its pattern."""
    n = F.length(_digits(found))
    octets = F.forall(F.split(found, r"\."), lambda part: F.length(F.regexp_replace(part, "^0+(?=.)", "")) <= 3) & F.forall(F.split(found, r"\."), lambda part: F.substring(F.regexp_replace(part, "^0+(?=.)", ""), 1, 3).cast("int") <= 255)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", octets)
        .when(kind == "card", (n >= 13) & (n <= 19) & F.when((n >= 13) & (n <= 19), _luhn(_digits(found))).otherwise(False))
        .when(kind == "phone", (n >= 9) & (n <= 15))
        .otherwise(False)
    )


def _item(rule: int, kind: str, base: bool):
    """What is kept of a rule's match x, the i-th of its text."""
    gaps = F.col(f"gaps_{rule}")
    return lambda x, i: F.struct(
        F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), F.lit(base).alias("base"), i.alias("place"), x.alias("found"),
        F.char_length(gaps[i]).alias("gap"), F.right(gaps[i], F.lit(_BEFORE)).alias("before"), F.left(gaps[i + 1], F.lit(_AFTER)).alias("after"),
    )


def _matches(docs: DataFrame, text: str, carried: list[str]) -> DataFrame:
    """A row for each match of a base rule or generator: the carried columns, kind, base, found, start, end, before, after.

    A row of docs without any match has one row with a null kind.
    """
    rules = [(kind, True, need, pattern) for kind, need, pattern in _BASE] + [(kind, False, need, pattern) for kind, need, pattern in _LOOSE]
    column = F.col(text)
    some = column.contains("@") | column.rlike("[0-9]") | column.rlike(_LOOSE[0][1])
    wanted = [some & (column.contains(need) if need == "@" else column.rlike(need)) for _, _, need, _ in rules]
    held = docs.select(
        *carried,
        *(F.when(test, F.regexp_extract_all(column, F.lit(pattern), F.lit(0))).alias(f"found_{k}") for k, (test, (*_, pattern)) in enumerate(zip(wanted, rules))),
        *(F.when(test, F.split(column, pattern, -1)).alias(f"gaps_{k}") for k, (test, (*_, pattern)) in enumerate(zip(wanted, rules))),
    )
    lists = [F.coalesce(F.transform(f"found_{k}", _item(k, kind, base)), F.array()) for k, (kind, base, _, _) in enumerate(rules)]
    rows = held.select(*carried, F.explode_outer(F.concat(*lists)).alias("m")).select(*carried, "m.*")
    return rows


def _placed(rows: DataFrame, key: str) -> DataFrame:
    """Adds start and end; the rows of a key lie together, so the sums over a text's matches need no further shuffle."""
    upto = Window.partitionBy(key, "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.char_length("found")).over(upto)
    return rows.repartition(key).withColumn("end", end.cast("int")).withColumn("start", (F.col("end") - F.char_length("found")).cast("int"))


_NEAR = (
    r"(?i)\b(?:call|phone|tel|fax|mobile|cell|whatsapp|dial|ring|telefon|t[ée]l[ée]phone|tel[ée]fono)\b",
    r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|carte|tarjeta|karte)\b",
    r"(?i)\b(?:ssn|social|security|taxpayer)\b",
    r"(?i)\b(?:iban|account|konto|compte|cuenta|bank)\b",
    r"(?i)\b(?:mail|e-mail|email|write|contact|reach)\b",
    r"(?i)\b(?:ip|host|server|address|node|peer)\b",
    r"(?i)(?:\b(?:order|invoice|isbn|issn|version|ref|reference|id|no|date|page|pages|part|sku|serial|ticket|build|lines?|range|score|year|years|from|between)\b|[$€£#%])",
)
FEATURES = 12 + len(_NEAR) + len(KINDS)


def features(found: Column, kind: Column, before: Column, after: Column) -> list[Column]:
    digits = _digits(found)
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, lambda g: F.length(g))
    number = lambda flag: F.when(flag, 1.0).otherwise(0.0)
    return [
        F.length(digits).cast("double"),
        F.char_length(found).cast("double"),
        F.size(groups).cast("double"),
        F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"),
        F.coalesce(F.array_min(sizes), F.lit(0)).cast("double"),
        F.length(F.regexp_replace(found, "[^-]", "")).cast("double"),
        F.length(F.regexp_replace(found, "[^.]", "")).cast("double"),
        F.length(F.regexp_replace(found, "[^/]", "")).cast("double"),
        F.length(F.regexp_replace(found, "[^()]", "")).cast("double"),
        number(F.when(F.length(digits) > 0, _luhn(digits)).otherwise(False)),
        number(found.rlike(r"(?:^|[^0-9])(?:1[89]|20)[0-9]{2}(?:[^0-9]|$)")),
        number(before.rlike(r"[A-Za-z0-9$€£#/.,:-]$") | after.rlike(r"^[A-Za-z0-9%/.,:-][0-9A-Za-z]")),
        *(number(before.rlike(pattern)) for pattern in _NEAR),
        *(number(kind == one) for one in KINDS),
    ]


def _examples(seed: int = 17, each: int = 45) -> list[tuple[str, str, int]]:
    """(text, kind, label): personal data and lookalikes of each kind in sentences."""
    rng = random.Random(seed)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 3)))
    fill = lambda: " ".join(word() for _ in range(rng.randint(2, 6)))

    def luhn(n: int) -> str:
        body = rng.choice("3456") + d(n - 2)
        return next(body + c for c in "0123456789" if sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(body + c))) % 10 == 0)

    def grouped(text: str, separator: str, size: int = 4) -> str:
        return separator.join(text[i : i + size] for i in range(0, len(text), size))

    good = {
        "email": [lambda: f"{word()}.{word()} [at] {word()} [dot] com", lambda: f"{word()}{d(2)}(at){word()}.org", lambda: f"{word()} at {word()} dot net", lambda: f"{word()}_{word()} {{at}} {word()} {{dot}} co {{dot}} uk"],
        "ip": [lambda: ":".join(rng.choice("0123456789abcdef") + d(rng.randint(1, 3)) for _ in range(8)), lambda: "[.]".join(str(rng.randint(1, 255)) for _ in range(4))],
        "card": [lambda: grouped(luhn(16), rng.choice([".", "/", "_", " - "])), lambda: grouped(luhn(16), "  ")],
        "phone": [lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"0{d(3)} {d(6)[:3]} {d(4)}", lambda: f"{d(2)}.{d(2)}.{d(2)}.{d(2)}.{d(2)}"],
        "ssn": [lambda: f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"],
        "iban": [lambda: f"{rng.choice(['DE', 'FR', 'ES', 'GB', 'NL'])}{d(2)} " + grouped(d(18), " "), lambda: f"{rng.choice(['DE', 'FR', 'ES'])}{d(20)}"],
    }
    bad = {
        "email": [lambda: f"{word()} at {word()} dot {word()}"],
        "ip": [lambda: ":".join(d(2) for _ in range(8))],
        "card": [lambda: grouped(d(16), rng.choice([".", "/", "_"])), lambda: f"{d(4)} - {d(4)} - {d(4)} - {d(4)}", lambda: f"{d(3)}_{d(6)}_{d(6)}"],
        "phone": [lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: f"{rng.randint(10, 28)}/{rng.randint(10, 12)}/{rng.randint(1990, 2030)}", lambda: f"{d(3)} {d(3)} {d(3)}", lambda: f"{d(4)}-{d(4)}", lambda: f"{d(3)}-{d(2)}-{d(5)}-{d(2)}", lambda: f"{d(2)}.{d(3)}.{d(3)}", lambda: f"{d(5)} {d(4)}"],
        "ssn": [lambda: f"{d(3)} {d(2)} {d(4)}", lambda: f"{d(3)}.{d(2)}.{d(4)}", lambda: f"000-{d(2)}-{d(4)}"],
        "iban": [lambda: f"{rng.choice(['AB', 'XK', 'QZ'])}{d(2)} " + " ".join(word().upper()[:4] for _ in range(4)), lambda: f"SN{d(14)}"],
    }
    told = {"email": ["write to", "contact", "mail", "reach me", ""], "ip": ["host", "server", "from ip", ""], "card": ["card", "visa", "credit card no", ""], "phone": ["call", "phone", "tel", "mobile", ""], "ssn": ["ssn", "social security", ""], "iban": ["iban", "account", ""]}
    odd = ["order", "invoice", "isbn", "version", "ref", "part no", "pages", "id", "$", "serial", "score", "", ""]
    rows = []
    for kind in KINDS:
        for label, made, cues in ((1, good[kind], told[kind]), (0, bad[kind], odd)):
            for make in made:
                for _ in range(each):
                    cue = rng.choice(cues)
                    cue, mark = (rng.choice(odd[:-2]), 0) if label and kind in ("phone", "ssn") and rng.random() < 0.1 else (cue, label)
                    rows.append((f"{fill()} {cue} {make()} {fill()}." if cue else f"{fill()}: {make()}, {fill()}.", kind, mark))
    return rows


@lru_cache(maxsize=4)
def _model(seed: int, session: SparkSession) -> tuple[boosting.Trees, dict[str, float]]:
    texts = session.createDataFrame([(i, text, kind, label) for i, (text, kind, label) in enumerate(_examples(seed))], "number long, text string, wanted string, label int")
    rows = _matches(texts, "text", ["number", "wanted", "label"]).where("NOT base AND kind = wanted")
    values = features(F.col("found"), F.col("kind"), F.col("before"), F.col("after"))
    found = sorted(tuple(row) for row in rows.select("number", "place", "kind", "label", *(v.alias(f"f{i}") for i, v in enumerate(values))).collect())
    table = np.array([row[4:] for row in found], float)
    labels, kinds, number = np.array([row[3] for row in found], float), np.array([row[2] for row in found]), np.array([row[0] for row in found])
    learn, fit, rest = (number % 4 < 2), (number % 4 == 2), (number % 4 == 3)
    trees = boosting.boost(table[learn], labels[learn])
    boosting.calibrate(trees, table[fit], labels[fit])
    probability = trees.probability(table)
    limits = {kind: max(0.5, boosting.threshold(probability[rest & (kinds == kind)], labels[rest & (kinds == kind)], PRECISION)) for kind in KINDS}
    return trees, limits


def model(spark: SparkSession, seed: int = 17) -> tuple[boosting.Trees, dict[str, float]]:
    """The trees and each kind's threshold, trained once for a session."""
    return _model(seed, spark)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "pii_spans") -> DataFrame:
    """The columns in keep (default: all of docs) and, under the name out, spans: array of (order of the kind, start, end, kind, base, p)."""
    trees, limits = model(docs.sparkSession)
    kept = [name for name in (docs.columns if keep is None else keep) if name.lower() != out.lower()]
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{name}`") for name in kept)).alias("kept"), F.col(f"`{text}`").alias("text"))
    rows = _placed(_matches(base, "text", ["row", "kept"]), "row")
    loose = F.col("kind").isNotNull() & ~F.col("base")
    p = F.when(loose, trees.column(features(F.col("found"), F.col("kind"), F.col("before"), F.col("after"))))
    limit = F.coalesce(*(F.when(F.col("kind") == kind, F.lit(value)) for kind, value in limits.items()))
    rows = rows.withColumn("p", p)
    rows = rows.withColumn("fine", F.when(F.col("base"), _valid(F.col("kind"), F.col("found"))).otherwise(F.col("p") >= limit))
    order = F.coalesce(*(F.when(F.col("kind") == kind, F.lit(i)) for i, kind in enumerate(KINDS)))
    span = F.struct(order.alias("order"), "start", "end", "kind", F.col("base").alias("base"), F.coalesce("p", F.lit(1.0)).alias("p"))
    spans = rows.groupBy("row").agg(F.first("kept").alias("kept"), F.array_sort(F.collect_list(F.when(F.col("fine"), span))).alias("spans"))
    touch = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    sure = F.filter("spans", lambda s: s["base"])
    other = F.filter("spans", lambda s: ~s["base"])
    parts = spans.select("kept", sure.alias("sure"), other.alias("other"))
    free = F.filter("other", lambda s: ~F.exists("sure", lambda t: touch(s, t)))
    names = ("order", "start", "end", "kind", "base", "p")
    best_first = F.array_sort(F.transform(free, lambda s: F.struct((-s["p"]).alias("rank"), *(s[name].alias(name) for name in names))))
    ordered = F.transform(best_first, lambda s: F.struct(*(s[name].alias(name) for name in names)))
    added = F.aggregate(ordered, F.filter(ordered, lambda s: F.lit(False)), lambda kept, s: F.when(F.exists(kept, lambda t: touch(s, t)), kept).otherwise(F.concat(kept, F.array(s))))
    every = F.when(F.size("other") > 0, F.array_sort(F.concat("sure", added))).otherwise(F.col("sure"))
    return parts.select("kept.*", every.alias(out))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span's characters replaced by asterisks; null texts stay null."""
    spans = common.fresh_name(docs, "spans")
    found = scan(docs, text, out=spans)
    column = F.col(f"`{text}`")
    blot = F.aggregate(spans, column, lambda acc, s: F.concat(F.substring(acc, F.lit(1), s["start"]), F.repeat(F.lit("*"), s["end"] - s["start"]), F.substring(acc, s["end"] + 1, F.char_length(acc))))
    return found.select(*(F.when(F.size(spans) > 0, blot).otherwise(column).alias(name) if name == text else F.col(f"`{name}`") for name in docs.columns))


def _written(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base rules' spans, and all spans."""
    found = scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    spans = F.col("pii_spans")
    sure = F.filter(spans, lambda s: s["base"])
    count = lambda kind: F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        common.sha256_of(_written(sure)).alias("base_sha256"),
        F.array_join(_written(spans), ",").alias("spans"),
        F.size(F.filter(spans, lambda s: ~s["base"])).cast("long").alias("n_added"),
    )
