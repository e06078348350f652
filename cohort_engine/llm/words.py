"""Words of texts laid end to end, as arrays."""

from __future__ import annotations

import hashlib

import numpy as np

from cohort_engine.llm.anchors import mixed

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Bytes whose words are hashed at once.
_PIECE = 1 << 15
_BASE = 0x5851F42D4C957F2D
_UP, _DOWN = np.full((2, _PIECE), _BASE, np.uint64)
_UP[0] = _DOWN[0] = 1
_DOWN[1:] = pow(_BASE, -1, 1 << 64)
_UP, _DOWN = np.multiply.accumulate(_UP), np.multiply.accumulate(_DOWN)
_VALUES = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256)
_LOWER[65:91] += 32


def word_spans(
    data: bytes, starts: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, number): places of all words, and how many words each text has."""
    letters = ~_SPACE[np.frombuffer(data, np.uint8)]
    cut = np.zeros(len(letters) + 1, bool)
    cut[1:-1] = letters[1:] != letters[:-1]
    # A text may begin or end amid letters.
    cut[starts] = True
    cut[starts + sizes] = True
    cuts = np.flatnonzero(cut[:-1])
    first = cuts[letters[cuts]] if len(cuts) else cuts
    ends = np.append(cuts[1:], len(letters)) if len(cuts) else cuts
    end = ends[letters[cuts]] if len(cuts) else cuts
    number = np.diff(np.searchsorted(first, np.append(starts, len(letters))))
    return first, end, number


def word_hashes(data: bytes, first: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` takes A-Z as a-z.

    It is a polynomial in the bytes of the word, from sums over stretches of words.
    """
    values = _VALUES[_LOWER] if lower else _VALUES
    array = np.frombuffer(data, np.uint8)
    out = np.zeros(len(first), np.uint64)
    sums = np.zeros(_PIECE + 1, np.uint64)
    at = 0
    while at < len(first):
        start = int(first[at])
        upto = int(np.searchsorted(end, start + _PIECE, "right"))
        if upto == at:  # a word longer than any stretch
            word = (_LOWER if lower else np.arange(256)).astype(np.uint8)[array[start : end[at]]]
            digest = hashlib.blake2b(word.tobytes(), digest_size=8).digest()
            out[at] = int.from_bytes(digest, "little")
            at += 1
            continue
        length = int(end[upto - 1]) - start
        np.cumsum(values[array[start : start + length]] * _UP[:length], out=sums[1 : length + 1])
        a, b = first[at:upto] - start, end[at:upto] - start
        out[at:upto] = (sums[b] - sums[a]) * _DOWN[a]
        at = upto
    return mixed(out)
