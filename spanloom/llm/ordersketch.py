"""Order MinHash sketches and banded alignment of word sequences."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

import numpy as np

SHINGLE = 5
SIMILARITY = 0.8
#: Occurrence-labelled shingles that one sketch component keeps; components that make a band key; bands.
KEPT = 2
COMPONENTS = 2
BANDS = 16

_WORD = re.compile(r"\w+")
_PLACES = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_SEEDS = np.random.default_rng(6).integers(1, 2**63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Elements of the matrix of hashes that a long text is worked on at once.
_CELLS = 1 << 21


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def word_hashes(words: Sequence[str]) -> np.ndarray:
    parts = [word.encode("utf-8", "replace") for word in words]
    sizes = np.array([len(part) for part in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(len(data)) - np.repeat(heads, sizes)
    factor = _PLACES[place % len(_PLACES)]
    if sizes.max() > len(_PLACES):  # another odd factor for every further turn, so each place has its own
        factor = factor * (2 * (place // len(_PLACES)) + 1).astype(np.uint64)
    return _mixed(np.add.reduceat(factor * (data + np.uint64(1)), heads))


def shingle_hashes(words: Sequence[str]) -> np.ndarray:
    """Hashes of the shingles in text order; of fewer words than a shingle has, one of them all."""
    hashes = word_hashes(words)
    n = max(1, len(hashes) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(hashes))):
        out = _mixed(out * _ODD + hashes[k : k + n])
    return out


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Each shingle's hash together with how often it occurred before."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.arange(len(ranked))
    occurrence = np.empty(len(ranked), np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return _mixed(shingles + occurrence * _ODD)


def band_keys(words: Sequence[str], bands: int = BANDS, components: int = COMPONENTS, kept: int = KEPT) -> np.ndarray:
    """One key for each band: texts that share a key are candidates.

    Each component takes the `kept` smallest of a random hash over the labelled
    shingles, in text order; a band's key hashes its components.
    """
    shingles = shingle_hashes(words)
    items = labelled(shingles)
    total = bands * components
    chosen = np.zeros(total, np.uint64)
    step = max(1, _CELLS // len(items))
    for first in range(0, total, step):
        seeds = _SEEDS[first : min(total, first + step)]
        matrix = (items[None, :] ^ seeds[:, None]) * _ODD
        matrix ^= matrix >> np.uint64(32)
        if matrix.shape[1] > kept:
            least = np.argpartition(matrix, kept - 1, axis=1)[:, :kept]
        else:
            least = np.broadcast_to(np.arange(matrix.shape[1]), matrix.shape)
        value = np.zeros(len(seeds), np.uint64)
        for column in np.sort(least, axis=1).T:
            value = _mixed(value * _ODD + items[column])
        chosen[first : first + len(seeds)] = value
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(components):
        keys = _mixed(keys * _ODD + chosen[k::components])
    return keys.view(np.int64)


class Shingles:
    """A text's shingle hashes in order, as a list and as a bag."""

    def __init__(self, stored: bytes) -> None:
        self.items: list[int] = np.frombuffer(stored, np.uint64).tolist()
        self.kinds = set(self.items)
        self.counts = None if len(self.kinds) == len(self.items) else Counter(self.items)

    def shared(self, other: Shingles) -> int:
        """Size of the bags' intersection: no alignment has more in common."""
        if self.counts is None or other.counts is None:
            return len(self.kinds & other.kinds)
        return (self.counts & other.counts).total()


def aligned(a: Shingles, b: Shingles, least: float = SIMILARITY) -> float:
    """Ordered similarity of two texts' shingle sequences: common / (|a| + |b| - common), where common is the length of
    the longest common subsequence of shingles.

    The alignment is banded: shingles are matched only within as many places
    as a pair of that similarity can be shifted. So a result under `least` may
    differ from the true value, which is then under `least` as well.
    """
    if len(a.items) > len(b.items):
        a, b = b, a
    n, m = len(a.items), len(b.items)
    if n < least * m:
        return 0.0
    most = a.shared(b)
    if most < least * (n + m - most):
        return 0.0
    x, y, head = a.items, b.items, 0
    while head < n and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < n - head and x[n - 1 - tail] == y[m - 1 - tail]:
        tail += 1
    common = head + tail
    if common < n:
        need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
        common += _banded(x[head : n - tail], y[head : m - tail], max(1, n + m - 2 * need))
    return common / (n + m - common)


def _banded(x: list[int], y: list[int], band: int) -> int:
    """Longest common subsequence within a band, on bit vectors: a zero bit of v is a step of the score along x."""
    places: dict[int, int] = {}
    for i, value in enumerate(x):
        places[value] = places.get(value, 0) | (1 << i)
    full = (1 << len(x)) - 1
    v, stripe = full, (1 << (2 * band + 1)) - 1
    for j, value in enumerate(y):
        match = places.get(value)
        if match:
            low = j - band
            u = v & match & (stripe << low if low >= 0 else stripe >> -low)
            if u:
                v = ((v + u) | (v - u)) & full
    return len(x) - v.bit_count()
