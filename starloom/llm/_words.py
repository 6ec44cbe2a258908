"""Words of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_LETTERS = np.random.default_rng(31).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[bool, np.ndarray] = {}


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, each followed by one space: bytes, begins, ends, words of each text."""
    rows = len(off) - 1
    buf = np.full(len(raw) + rows, 32, np.uint8)
    buf[np.arange(len(raw)) + np.repeat(np.arange(rows), np.diff(off))] = _LOWER[raw]
    space = _IS_SPACE[buf]
    keep = ~space
    keep[1:] |= ~space[:-1]
    buf[space] = 32
    ends_at = np.cumsum(keep)[off[1:] + np.arange(rows)] if rows else np.zeros(0, int)
    flat = buf[keep]
    stop = np.flatnonzero(flat == 32)
    start = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
    n = np.diff(np.searchsorted(stop, ends_at, "left"), prepend=0)
    return flat, start, stop, n


def _power(inverse: bool, n: int) -> np.ndarray:
    held = _powers.get(inverse)
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 21), pow(_BASE, -1, 2**64) if inverse else _BASE, np.uint64)
        steps[0] = 1
        held = _powers[inverse] = np.multiply.accumulate(steps)
    return held[:n]


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and how many each text has."""
    flat, start, stop, n = word_spans(raw, off)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_LETTERS[flat] * _power(False, len(flat)), out=sums[1:])
    h = (sums[stop] - sums[start]) * _power(True, len(flat) + 1)[start]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h, n
