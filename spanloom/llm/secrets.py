"""Secret scanning: format rules plus sliding-window entropy.

Three rules find secrets by their format: assignments to a telling name, access
keys, and long lower-case hex runs. On top, every candidate string (a run of
token characters) is slid over with a window per character class; the Shannon
entropy of the window comes from character counts that are updated by one
character leaving and one entering. Windows over the class's threshold are joined to
spans, unless the allow-list knows half of the window's characters or more: it
is asked for the parts between separators, so a harmless word beside a secret
doesn't hide it. Only windows that share no character with a format rule's span
count, so such a span doesn't hide what stands beside it either. A window needs
two digits and two letters; keys of letters alone are not told from words.

Spans are (kind, start, end) in code points, end exclusive. A null text has no
spans, like an empty one; an empty table gives no rows. Rows are scanned one by
one, so repeated rows, ties and extra columns pass through unchanged; a column
of the added one's name is replaced. Whole texts are scanned, in time that
grows with their length alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import common

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")


@dataclass(frozen=True)
class EntropyClass:
    """A character class, its window in characters, and the bits a character from which a window is suspicious."""

    name: str
    pattern: re.Pattern
    window: int
    bits: float


#: Random text of these classes has about 3.5 and 4.1 bits in such windows; words and numbers stay below the thresholds.
CLASSES = (
    EntropyClass("hex", re.compile(r"[0-9A-Fa-f]{24,}"), 24, 3.2),
    EntropyClass("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 20, 3.8),
)
_UUID = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])")
_PART = re.compile(r"[0-9A-Za-z]+")
#: Parts that are no secrets: numbers, words that may end in a short number, and what holds an alphabet or a placeholder.
_PLAIN = re.compile(r"[0-9]+|[A-Za-z]*[0-9]{0,4}")
_PLACEHOLDER = re.compile(r"0123456789|abcdefghij|ABCDEFGHIJ|EXAMPLE|example|PLACEHOLDER|placeholder|xxxx|XXXX")


def harmless(candidate: str) -> list[tuple[int, int]]:
    """The allow-list: stretches of the candidate that are no secrets, apart from separators."""
    found = [m.span() for m in _UUID.finditer(candidate)]
    return found + [m.span() for m in _PART.finditer(candidate) if _PLAIN.fullmatch(part := m.group()) or _PLACEHOLDER.search(part)]


def entropy_spans(
    candidate: str, classes: tuple[EntropyClass, ...] = CLASSES, allowed: Callable[[str], list[tuple[int, int]]] | None = harmless, taken: Iterable[tuple[int, int]] = ()
) -> list[tuple[int, int]]:
    """Stretches of the candidate that windows of high entropy, free of taken stretches, cover, joined where they touch."""
    known = bytearray(len(candidate))
    for start, end in allowed(candidate) if allowed else ():
        known[start:end] = b"\1" * (end - start)
    for start, end in taken:
        known[start:end] = b"\xff" * (end - start)  # more than any window may hold
    if all(known[a:b].find(0) < 0 for a, b in map(re.Match.span, _PART.finditer(candidate))):
        return []
    found: list[tuple[int, int]] = []
    for kind in classes:
        limit = kind.window * (math.log2(kind.window) - kind.bits)
        cost = [0.0] + [n * math.log2(n) for n in range(1, kind.window + 2)]
        for run in kind.pattern.finditer(candidate):
            text, first = run.group(), run.start()
            counts: dict[str, int] = {}
            total = 0.0  # sum of n log2 n over the window's characters: the entropy is log2(window) - total / window
            digits = letters = plain = 0
            for at, entering in enumerate(text):
                n = counts.get(entering, 0)
                total += cost[n + 1] - cost[n]
                counts[entering] = n + 1
                digits += entering.isdigit()
                letters += entering.isalpha()
                plain += known[first + at]
                if at >= kind.window:
                    leaving = text[at - kind.window]
                    n = counts[leaving]
                    total += cost[n - 1] - cost[n]
                    counts[leaving] = n - 1
                    digits -= leaving.isdigit()
                    letters -= leaving.isalpha()
                    plain -= known[first + at - kind.window]
                if at + 1 >= kind.window and digits >= 2 and letters >= 2 and 2 * plain < kind.window and total <= limit + 1e-9:
                    start, end = first + at + 1 - kind.window, first + at + 1
                    if found and found[-1][0] <= start <= found[-1][1]:
                        found[-1] = (found[-1][0], max(end, found[-1][1]))
                    else:
                        found.append((start, end))
    joined: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def find(text: str | None, retry: bool = False) -> list[tuple[int, int, int]]:
    """Spans (start, end, index in KINDS) of a text, by start, then kind. The first three kinds are the format rules.

    With retry, assignments that begin in one whose value is too short are found
    as well, which the format rule doesn't look at again: `secret: token: ...`.
    """
    if not text:
        return []
    met = list(_ASSIGN.finditer(text))
    if retry:
        met += [again for m in met if m.end(1) - m.start(1) < 6 and (again := _ASSIGN.match(text, m.start(1)))]
    assigned = sorted((m.start(), m.end(), 0) for m in met if m.end(1) - m.start(1) >= 6)
    spans, first = list(assigned), 0
    for run in _RUN.finditer(text):
        candidate, at = run.group(), run.start()
        known = [(at + m.start(), at + m.end(), 1) for m in _ACCESS.finditer(candidate) if m.end() - m.start() >= 20]
        known += [(at + m.start(), at + m.end(), 2) for m in _HEX.finditer(candidate)]
        spans += known
        while first < len(assigned) and assigned[first][1] <= at:
            first += 1
        last = first
        while last < len(assigned) and assigned[last][0] < run.end():
            last += 1
        taken = [(max(a, at) - at, min(b, run.end()) - at) for a, b, _ in known + assigned[first:last] if b > at]
        spans += [(at + start, at + end, 3) for start, end in entropy_spans(candidate, taken=taken)]
    return sorted(spans, key=lambda span: (span[0], span[2]))


SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, text: str = "text", spans: str = "secret_spans") -> DataFrame:
    """Adds the column of spans to docs; a column of that name is replaced."""
    kept = [name for name in docs.columns if name.lower() != spans.lower()]
    base = docs.select(*(F.col(f"`{name}`") for name in kept))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in find(one)] for one in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _ARROW_SPANS)], [*kept, spans])

    schema = T.StructType([*base.schema.fields, T.StructField(spans, T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    return common.by_batches(base, work, schema)


def blot(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """The text with each stretch of overlapping spans replaced by one mask."""
    parts, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The docs with every secret in their texts masked, those that only a retry finds, too; null texts stay null, texts without secrets stay as they are."""
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(text)
            texts = batch.column(k).to_pylist()
            new = [one if one is None or not (found := find(one, retry=True)) else blot(one, [(a, b) for a, b, _ in found], mask) for one in texts]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == k else column for i, column in enumerate(batch.columns)], names)

    return common.by_batches(docs, work, docs.schema)


def written(spans: str | Column) -> Column:
    """Spans as an array of kind:start:end."""
    return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the format rules' spans, and all spans."""
    found = scan(common.table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secret_spans")
    spans = F.col("secret_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        common.sha256_of(written(F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS)))).alias("base_sha256"),
        F.array_join(written(spans), ",").alias("spans"),
        count("entropy").alias("n_entropy"),
    )
