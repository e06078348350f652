"""Anchors of windows: places that equal windows have in common.

All windows of one length are covered by a few anchors. The anchor of a window is its
k-gram with the smallest hash, the leftmost of equals. It depends on nothing outside the
window, so that equal windows have equal anchors at the same place, and only windows
whose anchors occur twice can occur twice. Windows side by side mostly share an anchor;
such a run of windows is the unit of work.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_STRETCH = 1 << 15
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = np.uint64(0xFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, 1 << 16)
_DOWN = _powers(_INVERSE, 1 << 16)


def mixed(keys: np.ndarray) -> np.ndarray:
    """Keys with their bits spread."""
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(32))


@dataclass
class Runs:
    """Runs of windows: those that start at ``low`` to ``high`` have their anchor at ``at``.

    ``gram`` is the hash of the anchor, ``whole`` that of all symbols of the windows and
    of the place of the anchor among them; ``text`` is the number of the text.
    """

    gram: np.ndarray
    whole: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    text: np.ndarray

    def take(self, which: np.ndarray) -> Runs:
        return Runs(*(getattr(self, n)[which] for n in self.__dataclass_fields__))


def runs(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, window: int, gram: int) -> Runs:
    """Runs of all windows inside the texts laid end to end in ``symbols`` (uint64)."""
    n = len(symbols)
    ends = np.repeat(starts + sizes, sizes)
    numbers = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    parts = []
    for first in range(0, max(0, n - window + 1), _STRETCH):
        last = min(first + _STRETCH, n - window + 1)
        piece = symbols[first : last + window - 1]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * _UP[: len(piece)], out=sums[1:])
        grams = mixed((sums[gram:] - sums[:-gram]) * _DOWN[: len(piece) - gram + 1])
        places = np.arange(len(grams), dtype=np.uint64)
        least = (grams & ~_PLACE) | places
        reach, covered = window - gram + 1, 1
        while covered < reach:
            step = min(covered, reach - covered)
            least = np.minimum(least[: len(least) - step], least[step:])
            covered += step
        starting = np.arange(first, last)
        inside = np.flatnonzero(starting + window <= ends[first:last])
        if not len(inside):
            continue
        at = (least[inside] & _PLACE).astype(np.int64)
        new = np.ones(len(inside), bool)
        new[1:] = (at[1:] != at[:-1]) | (np.diff(inside) != 1)
        begin = np.flatnonzero(new)
        low = inside[begin]
        high = inside[np.append(begin[1:], len(inside)) - 1]
        at = at[begin]
        whole = (sums[high + window] - sums[low]) * _DOWN[low]
        shape = ((at - low) << 16 | (high - low)).astype(np.uint64)
        whole = mixed(whole + mixed(shape + np.uint64(1)))
        parts.append((grams[at], whole, at + first, low + first, high + first, numbers[low + first]))
    if not parts:
        none = np.zeros(0, np.int64)
        return Runs(none.astype(np.uint64), none.astype(np.uint64), none, none, none, none)
    return Runs(*(np.concatenate(c) for c in zip(*parts, strict=True)))


def covered(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals [low, high), as ascending intervals that don't touch."""
    order = np.lexsort((high, low))
    low, high = low[order], np.maximum.accumulate(high[order]) if len(high) else high
    if not len(low):
        return low, high
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1]
    begin = np.flatnonzero(new)
    return low[begin], high[np.append(begin[1:], len(low)) - 1]
