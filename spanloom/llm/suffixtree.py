"""A probabilistic suffix tree over bytes, in numpy.

A state is a context of at most DEPTH bytes. Contexts are kept if they are
frequent and if their next-byte distribution diverges from that of their suffix
(count x Kullback-Leibler divergence); suffixes of kept contexts are kept.
Distributions are smoothed along the suffix chain (Witten-Bell), so no byte has
probability zero. A text is scored by the longest suffix state at each byte.

Contexts of up to SHALLOW bytes make a small tree that one machine holds (at
most 256^3 codes); chances() answers for all longer ones from the codes that
share their last SHALLOW + 1 bytes.

Texts are their lower-cased tokens joined by blanks and closed by END; contexts
at the start of a text are filled up with END.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

DEPTH = 6
SHALLOW = 2
END = 10
#: Divergence (in nats, times the context's count) that a context needs.
LEAST_GAIN = 12.0

_SYMBOLS = 256
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_CACHE_BITS = 22
#: Bytes whose codes are made at once, so that what is between fits a cache.
_PIECE = 1 << 15


def tokens_of(text: str | None) -> list[bytes]:
    """Maximal runs of characters other than blank and \\t \\n \\v \\f \\r, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower().split()


def block_of(tokens: Sequence[list[bytes]]) -> bytes:
    """The texts in lines, END between them."""
    return bytes([END]).join([b" ".join(one) for one in tokens])


def codes_of_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of a block's texts, the DEPTH bytes before it and itself as one number; and where each text starts."""
    end = bytes([END])
    data = np.frombuffer(end * DEPTH + block.replace(end, end * (DEPTH + 1)) + end, np.uint8)
    size = len(data) - DEPTH
    codes = np.empty(size, np.uint64)
    for at in range(0, size, _PIECE):
        piece = data[at : at + _PIECE + DEPTH].astype(np.uint64)
        pairs = (piece[:-1] << np.uint64(8)) | piece[1:]
        fours = (pairs[:-2] << np.uint64(16)) | pairs[2:]
        codes[at : at + _PIECE] = (fours[:-3] << np.uint64(24)) | (fours[3:] & np.uint64(0xFFFFFF))
    ends = np.flatnonzero(np.frombuffer(block, np.uint8) == END)
    starts = np.concatenate([[0], ends + 1, [len(block) + 1]])
    real = np.ones(size, bool)
    for k in range(DEPTH):
        real[starts[1:-1] + DEPTH * np.arange(len(ends)) + k] = False
    return codes[real], starts


def codes_of(tokens: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """codes_of_block of texts given by their tokens."""
    return codes_of_block(block_of(tokens)) if len(tokens) else (np.zeros(0, np.uint64), np.zeros(1, np.int64))


def words_of_block(block: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, int]:
    """Distinct words of a block; for every word its number among them and its text's number; and the number of texts."""
    import pyarrow as pa

    data = np.frombuffer(block.replace(bytes([END]), b" ") + b" ", np.uint8)
    ends = np.flatnonzero(data == 32)
    last = np.concatenate([np.frombuffer(block, np.uint8) == END, [True]])[ends]
    offsets = np.concatenate([[0], ends + 1]).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    text = np.cumsum(last) - last
    real = np.diff(offsets) > 1
    return [word[:-1] for word in coded.dictionary.to_pylist()], coded.indices.to_numpy()[real], text[real], int(last.sum())


def distinct(codes: np.ndarray) -> np.ndarray:
    """Distinct codes in order."""
    codes = np.sort(codes)
    return codes[np.concatenate([[True], codes[1:] != codes[:-1]])] if len(codes) else codes


def counted(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often they occur."""
    if counts is None:
        codes = np.sort(codes)
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
        return codes[first], np.diff(np.concatenate([first, [len(codes)]])).astype(np.int64)
    order = np.argsort(codes, kind="stable")  # runs that are in order are merged
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


_MIX = 0x9E3779
_MIX_BACK = pow(_MIX, -1, 1 << 24)


def turned(codes: np.ndarray) -> np.ndarray:
    """Codes with the context's last three bytes first, mixed: equal ones are together in order, and their top bits deal them evenly."""
    near = (((codes >> np.uint64(8)) & np.uint64(0xFFFFFF)) * np.uint64(_MIX)) & np.uint64(0xFFFFFF)
    return (near << np.uint64(32)) | ((codes >> np.uint64(32)) << np.uint64(8)) | (codes & np.uint64(0xFF))


def turned_back(codes: np.ndarray) -> np.ndarray:
    near = ((codes >> np.uint64(32)) * np.uint64(_MIX_BACK)) & np.uint64(0xFFFFFF)
    return (((codes >> np.uint64(8)) & np.uint64(0xFFFFFF)) << np.uint64(32)) | (near << np.uint64(8)) | (codes & np.uint64(0xFF))


class Table:
    """Open addressing from 64-bit keys to floats."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.keys = np.full(1 << self.bits, _EMPTY)
        self.values = np.zeros(1 << self.bits, np.float32)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] == _EMPTY
            take = left[free]
            self.keys[slots[take]] = keys[take]
            won = self.keys[slots[left]] == keys[left]
            self.values[slots[left[won]]] = values[left[won]]
            left = left[~won]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which keys are there."""
        values, found = np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            held = self.keys[slots[left]]
            hit = held == keys[left]
            values[left[hit]] = self.values[slots[left[hit]]]
            found[left[hit]] = True
            left = left[~hit & (held != _EMPTY)]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
        return values, found


def _tagged(codes: np.ndarray, length: int) -> np.ndarray:
    """Codes of that many bytes, told from those of other lengths."""
    return (codes & np.uint64((1 << (8 * length)) - 1)) | np.uint64((length + 1) << 56)


@dataclass
class Model:
    """Natural logs: of a state's seen next bytes, and of what is left to its suffix for the unseen ones."""

    seen_keys: np.ndarray
    seen_logs: np.ndarray
    state_keys: np.ndarray
    state_logs: np.ndarray
    depth: int = DEPTH
    _tables: tuple[Table, Table] | None = field(default=None, repr=False)
    _cache: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)

    def _logs(self, codes: np.ndarray) -> np.ndarray:
        if self._tables is None:
            self._tables = Table(self.seen_keys, self.seen_logs), Table(self.state_keys, self.state_logs)
        seen, states = self._tables
        logs, spared = np.full(len(codes), -np.log(_SYMBOLS)), np.zeros(len(codes))
        left, asked = np.zeros(0, np.int64), np.arange(len(codes))  # those whose longest state is found, and the others
        for depth in range(self.depth, -1, -1):
            values, live = states.get(_tagged(codes[asked] >> np.uint64(8), depth) | np.uint64(1 << 63))
            further, _ = states.get(_tagged(codes[left] >> np.uint64(8), depth) | np.uint64(1 << 63))
            left = np.concatenate([left, asked[live]])
            rest = np.concatenate([further, values[live]])
            asked = asked[~live]
            seen_logs, found = seen.get(_tagged(codes[left], depth + 1))
            at = left[found]
            logs[at] = seen_logs[found] + spared[at]
            left, rest = left[~found], rest[~found]
            spared[left] += rest
        logs[left] += spared[left]
        return logs

    def score(self, tokens: Sequence[list[bytes]]) -> np.ndarray:
        """log10 probability of each text."""
        codes, starts = codes_of(tokens)
        if self._cache is None:
            self._cache = np.full(1 << _CACHE_BITS, _EMPTY), np.zeros(1 << _CACHE_BITS, np.float64)
        keys, values = self._cache
        slots = ((codes * _FACTOR) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
        missed = np.flatnonzero(keys[slots] != codes)
        logs = values[slots]
        if len(missed):
            new, back = np.unique(codes[missed], return_inverse=True)
            found = self._logs(new)
            logs[missed] = found[back]
            at = ((new * _FACTOR) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
            at, one = np.unique(at, return_index=True)
            keys[at], values[at] = new[one], found[one]
        return np.add.reduceat(logs, starts[:-1]) / np.log(10) if len(logs) else np.zeros(0)


def grow(levels: Sequence[tuple[np.ndarray, np.ndarray]], least_gain: float = LEAST_GAIN, also: np.ndarray | None = None) -> Model:
    """The tree from, for each depth, the codes (context and next byte) of its frequent contexts and their counts.

    A level must hold the suffixes of the next one's contexts. Of the last
    level, the contexts in also are kept whatever their gain.
    """
    one = np.uint64(8)
    ordered = []
    for codes, counts in levels:
        order = np.argsort(codes)
        ordered.append((codes[order], counts[order].astype(np.float64)))
    totals, groups, gains = [], [], []
    for depth, (codes, counts) in enumerate(ordered):
        contexts, group = np.unique(codes >> one, return_inverse=True)
        total = np.bincount(group, counts, len(contexts))
        if depth == 0:
            gain = np.full(len(contexts), np.inf)
        else:
            before, number = ordered[depth - 1]
            at = np.searchsorted(before, codes & np.uint64((1 << (8 * depth)) - 1))
            wider = number[at] / totals[depth - 1][1][groups[depth - 1][at]]
            gain = np.bincount(group, counts * np.log(counts / total[group] / wider), len(contexts))
        totals.append((contexts, total))
        groups.append(group)
        gains.append(gain)
    kept = [gain >= least_gain for gain in gains]
    if also is not None:
        kept[-1] |= np.isin(totals[-1][0], also)
    for depth in range(len(ordered) - 1, 0, -1):
        suffixes = np.unique(totals[depth][0][kept[depth]] & np.uint64((1 << (8 * (depth - 1))) - 1))
        kept[depth - 1][np.searchsorted(totals[depth - 1][0], suffixes)] = True
    seen_keys, seen_logs, state_keys, state_logs = [], [], [], []
    chances: np.ndarray = np.zeros(0)
    for depth, (codes, counts) in enumerate(ordered):
        group, (contexts, total) = groups[depth], totals[depth]
        kinds = np.bincount(group, minlength=len(contexts)).astype(np.float64)
        if depth == 0:
            wider = np.full(len(codes), 1.0 / _SYMBOLS)
        else:
            wider = chances[np.searchsorted(ordered[depth - 1][0], codes & np.uint64((1 << (8 * depth)) - 1))]
        chances = (counts + kinds[group] * wider) / (total + kinds)[group]
        live = kept[depth][group]
        seen_keys.append(_tagged(codes[live], depth + 1))
        seen_logs.append(np.log(chances[live]))
        state_keys.append(_tagged(contexts[kept[depth]], depth) | np.uint64(1 << 63))
        state_logs.append(np.log(kinds / (total + kinds))[kept[depth]])
    flat = lambda parts, kind: np.concatenate([*parts, np.zeros(0)]).astype(kind) if kind != np.uint64 else np.concatenate([*parts, np.zeros(0, np.uint64)])
    return Model(flat(seen_keys, np.uint64), flat(seen_logs, np.float32), flat(state_keys, np.uint64), flat(state_logs, np.float32), len(levels) - 1)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys, and the number of each key among them."""
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    return keys[first], np.cumsum(first) - 1


def chances(codes: np.ndarray, counts: np.ndarray, wider: np.ndarray, shares: np.ndarray, least: int, least_gain: float = LEAST_GAIN) -> tuple[np.ndarray, np.ndarray]:
    """Natural logs of codes whose longest state is deeper than SHALLOW, NaN for the others; and the suffixes of SHALLOW bytes of states.

    codes are distinct and sorted, counts 0 where a code is only asked for; all
    codes of a corpus that share their context's last SHALLOW + 1 bytes must be
    there. wider and shares are, for each code, the smoothed chance and the
    share of its last byte after the SHALLOW bytes before it.
    """
    if not len(codes):
        return np.zeros(0), np.zeros(0, np.uint64)
    levels = [(codes, counts.astype(np.float64))]
    inner = []  # from the codes of a level to those of the level above
    for depth in range(DEPTH - 1, SHALLOW, -1):
        shorter, back = np.unique(levels[-1][0] & np.uint64((1 << (8 * (depth + 1))) - 1), return_inverse=True)
        inner.append(back)
        levels.append((shorter, np.bincount(back, levels[-1][1], len(shorter))))
    to_top = np.arange(len(codes))
    for back in inner:
        to_top = back[to_top]
    first = np.zeros(len(levels[-1][0]), np.int64)
    first[to_top] = np.arange(len(codes))
    wider, shares = wider[first], shares[first]
    inner.reverse()
    levels.reverse()
    smooth, states = [], []
    for k, (own, number) in enumerate(levels):
        if k:
            wider, shares = smooth[-1][inner[k - 1]], shares[inner[k - 1]]
        contexts, group = _grouped(own >> np.uint64(8))
        total = np.bincount(group, number)
        kinds = np.bincount(group, number > 0)
        live = total >= least
        smooth.append(np.where(live[group], (number + kinds[group] * wider) / np.maximum(total + kinds, 1)[group], wider))
        seen = (number > 0) & live[group]
        share = number / np.maximum(total, 1)[group]
        gain = np.bincount(group[seen], number[seen] * np.log(share[seen] / shares[seen]), len(contexts))
        states.append([contexts, group, live & (gain >= least_gain)])
        shares = share
    for k in range(len(levels) - 1, 0, -1):
        contexts, _, kept = states[k]
        at = np.searchsorted(states[k - 1][0], contexts[kept] & np.uint64((1 << (8 * (SHALLOW + k))) - 1))
        states[k - 1][2][at] = True
    logs = np.full(len(levels[0][0]), np.nan)
    for k in range(len(levels)):
        if k:
            logs = logs[inner[k - 1]]
        kept = states[k][2][states[k][1]]
        logs[kept] = np.log(smooth[k][kept])
    return logs, np.unique(states[0][0][states[0][2]] & np.uint64((1 << (8 * SHALLOW)) - 1))
