"""Vectorised word boundaries and word hashes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_rng = np.random.default_rng(20240501)
_LETTER = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(2**57, 2**60)) * 8 + 5
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: A word is a run of bytes that are none of space, tab, LF, VT, FF, CR.
BY_SPACE = np.ones(256, bool)
BY_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: A word is a run of ASCII letters, ASCII digits and characters outside ASCII.
BY_LETTER = np.zeros(256, bool)
BY_LETTER[128:] = BY_LETTER[48:58] = BY_LETTER[65:91] = BY_LETTER[97:123] = True


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, np.uint64(base), np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words(texts: Sequence[str], table: np.ndarray = BY_SPACE, lower: bool = False):
    """(bytes, starts, ends, hashes, offsets): the words of text i are offsets[i]:offsets[i + 1]."""
    parts = [(t.lower() if lower else t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    raw = b" ".join(parts) + b" "
    a = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(a) + 1, np.int8)
    inside[1:] = table[a]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    up, down = _pow(len(a) + 1)
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_LETTER[a] * up[: len(a)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=at[1:])
    return raw, starts, ends, hashes, np.searchsorted(starts, at)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words, boundaries of texts ignored: result i covers i:i + n."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    up, down = _pow(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=total[1:])
    return mix((total[n:] - total[:-n]) * down[: len(hashes) - n + 1])


def chunks(texts: Sequence[str | None], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``limit`` characters; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
