"""Recognisers of personal and medical identifiers in a text.

Patterns give (type, start, end, score); words near a match raise its score; of
matches of one type the better one of two nested ones stays. Names, places,
organisations and groups come from a backend that is given, or not at all.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import accumulate, groupby


@dataclass(frozen=True)
class Entity:
    type: str
    start: int
    end: int
    score: float


# Patterns with their scores, and the words whose nearness raises them.
_MONTHS = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_BIRTH = r"(?i)(?:DOB|Date\s+of\s+Birth|Born|Birth\s+Date|Birthdate)[:\s]+"
PATTERNS: dict[str, tuple[tuple[str, float], ...]] = {
    "DATE_OF_BIRTH": ((_BIRTH + r"\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}", 0.95), (_BIRTH + r"\d{4}-\d{2}-\d{2}", 0.95), (r"\b\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}\b", 0.40)),
    "MEDICAL_RECORD_NUMBER": (
        (r"(?i)(?:MRN|Medical\s+Record(?:\s+No\.?)?|Patient\s+I(?:D|dentification))[:\s#\-]*\d{4,10}", 0.92),
        (r"(?i)(?:MRN|Medical\s+Record(?:\s+No\.?)?|Patient\s+I(?:D|dentification)|Insurance\s+Policy|Policy)\s*(?:No\.?|Number|#)?[:\s#\-]+[A-Z]{2,4}-[A-Z0-9]{2,8}(?:-[A-Z0-9]{2,8})?", 0.90),
        (r"\bMRN[-\s]?\d{6,10}\b", 0.88),
        (r"\b[A-Z]{2,4}-\d{4,8}\b", 0.20),
        (r"\b[A-Z]{2,4}-\d{2,6}-[A-Z0-9]{2,6}\b", 0.20),
        (r"\b\d{6,10}\b", 0.20),
    ),
    "AGE": ((r"(?i)(?:age[d]?|years?\s+old)[:\s]+\d{1,3}", 0.85), (r"\b\d{1,3}\s*(?:years?|yrs?)[\s\-]+old\b", 0.85), (r"\b\d{1,3}-year-old\b", 0.88)),
    "ZIP_CODE": ((r"\b\d{5}-\d{4}\b", 0.90), (r"\b\d{5}\b", 0.40)),
    "MEDICAL_LICENSE": ((r"(?i)(?:NPI|National\s+Provider\s+Identifier)(?:\s+#)?[:\s#]+\d{10}\b", 0.92), (r"\b\d{10}\b", 0.38)),
    "US_BANK_NUMBER": ((r"\b\d{9}\b", 0.40), (r"\b\d{8,17}\b", 0.41)),
    "MEDICARE_ID": ((r"(?i)(?:Medicare\s+Beneficiary\s+(?:ID|Identifier)|MBI)[:\s#]+[1-9][A-Z][A-Z0-9]{2}-[A-Z0-9]{3}-[A-Z0-9]{4}\b", 0.95), (r"\b[1-9][A-Z][A-Z0-9]{2}-[A-Z0-9]{3}-[A-Z0-9]{4}\b", 0.80)),
    "URL": ((r"\bwww\.[a-zA-Z0-9][a-zA-Z0-9\-\.]+\.[a-zA-Z]{2,}(?:[/?#][^\s]*)?\b", 0.85), (r"\b[a-zA-Z0-9][a-zA-Z0-9\-]+\.(?:com|net|org|io|co|me|info|edu|gov|mil)\b", 0.50)),
    "DATE_TIME": (
        (rf"(?i)\b\d{{1,2}}(?:st|nd|rd|th){_MONTHS}\d{{2,4}}\b", 0.88),
        (rf"(?i)\b\d{{1,2}}{_MONTHS}\d{{2,4}}\b", 0.85),
        (rf"(?i)\b\d{{1,2}}(?:st|nd|rd|th)?\s+{_MONTHS}\s+\d{{2,4}}\b", 0.88),
        (rf"(?i)\b{_MONTHS}\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{2,4}}\b", 0.88),
        (rf"(?i)\b\d{{1,2}}[\-./]{_MONTHS}[\-./]\d{{2,4}}\b", 0.88),
        (r"\b(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\b", 0.70),
    ),
    "GENDER": (
        (r"(?i)\b(?:male|female|males|females|man|woman|men|women|boy|girl|boys|girls|gentleman|lady|gentlemen|ladies)\b", 0.40),
        (r"(?i)\b(?:Mr|Mrs|Ms|Mx|Mister|Missus)\.?(?=\s|$)", 0.45),
        (r"(?i)\b(?:gender|sex)\s*[:=]\s*(?:m|f|male|female|man|woman|other)\b", 0.85),
    ),
    "US_SSN": ((r"\b(?!000|666)\d{3}[-\s.]\d{2}[-\s.]\d{4}\b", 0.85), (r"\b(?!000000000|666\d{6})\d{9}\b", 0.40)),
}
CONTEXT: dict[str, tuple[str, ...]] = {
    "DATE_OF_BIRTH": ("dob", "date of birth", "born", "birth date", "birthdate", "birthday", "d.o.b", "birth", "born on", "year of birth"),
    "MEDICAL_RECORD_NUMBER": ("mrn", "chart", "encounter", "registration", "emr", "ehr", "policy", "identification", "hospital", "record", "medical", "medical record", "medical record number", "patient id", "patient identification", "patient identification number", "identification number", "record number", "chart number", "case number", "file number", "visit number", "member id", "health record", "record #", "policy number", "insurance policy"),
    "AGE": ("age", "aged", "years old", "yrs", "yr", "years of age", "patient age", "pediatric", "geriatric", "neonatal", "adolescent", "child", "adult", "elderly", "infant"),
    "ZIP_CODE": ("zip", "zip code", "zipcode", "postal", "postal code", "post code", "mailing code", "city", "state", "address"),
    "MEDICAL_LICENSE": ("npi", "national provider identifier", "national provider", "provider id", "provider identifier", "npi number", "prescriber npi", "rendering npi", "billing npi", "ordering npi", "referring npi"),
    "US_BANK_NUMBER": ("account", "account number", "acct", "routing", "routing number", "bank account", "checking", "savings", "aba", "aba number", "wire transfer", "direct deposit", "bank routing", "transit"),
    "MEDICARE_ID": ("medicare", "beneficiary", "mbi", "medicare id", "beneficiary id", "medicare beneficiary", "cms", "medicare card"),
    "URL": ("website", "blog", "site", "portfolio", "online", "visit", "www", "web", "url", "link", "page", "profile", "personal", "my site", "my website", "my blog", "my page"),
    "DATE_TIME": ("date", "on", "admitted", "joined", "born", "dob", "until", "since", "from", "scheduled", "appointment", "visit", "discharged"),
    "GENDER": ("gender", "sex", "patient", "identifies as", "biological sex", "assigned sex"),
    "US_SSN": ("ssn", "ssn#", "ssn:", "ss#", "social security", "social security number", "social security #"),
}
DIRECT = ("EMAIL_ADDRESS", "PHONE_NUMBER", "US_SSN", "CREDIT_CARD", "US_DRIVER_LICENSE", "US_PASSPORT", "IP_ADDRESS", "IBAN_CODE", "MEDICAL_LICENSE", "MEDICAL_RECORD_NUMBER", "US_BANK_NUMBER", "MEDICARE_ID", "URL")
QUASI = ("PERSON", "AGE", "DATE_TIME", "DATE_OF_BIRTH", "LOCATION", "ZIP_CODE", "NRP", "ORG", "GENDER")
TYPES = (*DIRECT, *QUASI)


def _luhn(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def _iban(text: str) -> bool:
    flat = re.sub(r"\s", "", text).upper()
    return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def _octets(text: str) -> bool:
    return all(int(part) <= 255 for part in text.split("."))


#: Common identifiers with checks of this library's own: type, pattern (a group "own" is the identifier, if there is one), score, test, nearby words.
_OWN: tuple[tuple[str, str, float, Callable[[str], bool] | None, tuple[str, ...]], ...] = (
    ("EMAIL_ADDRESS", r"(?<![\w.%+-])[.%+-]*+(?P<own>[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\b)", 1.0, None, ("email", "mail")),
    ("PHONE_NUMBER", r"(?<![\w.])(?:\+\d{1,3}[\s.-]?)?(?:\(\d{3}\)\s?|\d{3}[\s.-])\d{3}[\s.-]\d{4}(?!\w)", 0.75, None, ("phone", "call", "tel", "mobile", "fax")),
    ("CREDIT_CARD", r"\b\d(?:[ -]?\d){12,18}\b", 0.9, _luhn, ("card", "credit", "visa", "mastercard")),
    ("IBAN_CODE", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}\b", 0.9, _iban, ("iban", "account")),
    ("IP_ADDRESS", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])", 0.8, _octets, ("ip", "address", "host")),
    ("US_PASSPORT", r"\b[A-Z]\d{8}\b", 0.1, None, ("passport", "travel document")),
    ("US_DRIVER_LICENSE", r"\b[A-Z]\d{7}\b", 0.1, None, ("driver", "license", "licence", "dl")),
)
_COMPILED = tuple((kind, re.compile(pattern), score, None) for kind, patterns in PATTERNS.items() for pattern, score in patterns) + tuple((kind, re.compile(pattern), score, test) for kind, pattern, score, test, _ in _OWN)
_NEAR = CONTEXT | {kind: words for kind, *_, words in _OWN}

#: How much a nearby word adds, the least score with one, and how many words before a match are near.
BOOST, LEAST_BOOSTED, NEAR_WORDS = 0.35, 0.40, 5


@dataclass(frozen=True)
class Policy:
    """Which types count and from what score; types that it doesn't name count."""

    score_threshold: float = 0.35
    enabled: Mapping[str, bool] = field(default_factory=dict)
    overrides: Mapping[str, float] = field(default_factory=dict)

    @classmethod
    def of(cls, settings: Mapping) -> Policy:
        types = settings.get("entities", {})
        return cls(float(settings.get("score_threshold", 0.7)), {k: bool(v.get("enabled", True) if isinstance(v, Mapping) else v) for k, v in types.items()})

    @classmethod
    def load(cls, path: str | None = None, score_threshold: float | None = None) -> Policy:
        """From a YAML or JSON file; without one every type counts, from 0.7. A threshold that is given counts instead of the file's."""
        from spanloom.sources.tables import read_settings

        return cls.of(read_settings(path, None if score_threshold is None else {"score_threshold": score_threshold}))

    def takes(self, entity: Entity) -> bool:
        return self.enabled.get(entity.type, True) and entity.score >= self.overrides.get(entity.type, self.score_threshold)


Backend = Callable[[str], Iterable[Entity]]


def boosted(text: str, found: Entity) -> Entity:
    """The entity with a higher score if one of its type's words is among those before it."""
    before = " ".join(text[max(0, found.start - 120) : found.start].lower().split()[-NEAR_WORDS:])
    if found.type not in _NEAR or not any(word in before for word in _NEAR[found.type]):
        return found
    return Entity(found.type, found.start, found.end, min(1.0, max(found.score + BOOST, LEAST_BOOSTED)))


def without_nested(found: Sequence[Entity]) -> list[Entity]:
    """Of each type, entities that lie in no better one; of equals the first and longest stays."""
    kept: list[Entity] = []
    better: list[tuple[int, int]] = []
    last = None
    for (kind, _), level in groupby(sorted(found, key=lambda e: (e.type, -e.score, e.start, -e.end)), key=lambda e: (e.type, e.score)):
        if kind != last:
            better, last = [], kind
        starts = [start for start, _ in better]
        reaches = list(accumulate((end for _, end in better), max))
        reach = -1
        for one in level:
            before = bisect_right(starts, one.start) - 1
            if reach < one.end and (before < 0 or reaches[before] < one.end):
                kept.append(one)
                reach = one.end
        better = sorted((e.start, e.end) for e in kept if e.type == kind)
    return sorted(kept, key=lambda e: (e.start, e.end, e.type))


def detect(text: str | None, policy: Policy = Policy(), backend: Backend | None = None) -> list[Entity]:
    """All entities of a text that the policy takes, by place."""
    if not text or not text.strip():
        return []
    own = lambda pattern, m: m.span("own" if "own" in pattern.groupindex else 0)
    found = [boosted(text, Entity(kind, *own(pattern, m), score)) for kind, pattern, score, test in _COMPILED for m in pattern.finditer(text) if test is None or test(m.group())]
    for one in backend(text) if backend else ():
        short_name = one.type == "ORG" and text[one.start : one.end].isupper() and one.end - one.start <= 5
        if not short_name:
            found.append(one)
    return [one for one in without_nested(found) if policy.takes(one)]


def dictionary_backend(words: Mapping[str, str], score: float = 0.85) -> Backend:
    """A backend that knows words by heart; for tests, and for closed lists."""
    table = {word: (re.compile(rf"\b{re.escape(word)}\b"), kind) for word, kind in words.items()}
    return lambda text: [Entity(kind, m.start(), m.end(), score) for pattern, kind in table.values() for m in pattern.finditer(text)]
