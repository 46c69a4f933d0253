"""Sets of five-word shingles as sorted 64-bit hashes, computed with numpy on whole texts."""

from __future__ import annotations

import numpy as np

WORDS = 5
PIECE = 1 << 20  # bytes of text hashed at a time

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = np.uint64(0x9E3779B97F4A7C15)  # odd: a byte's place in its word
_WORD = _RNG.integers(1, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over the whole number, one to one."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _word_hashes(piece: bytes) -> np.ndarray:
    a = np.frombuffer(b" " + piece + b" ", np.uint8)
    space = _SPACE[a]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _PLACE, np.uint64))
    first = np.zeros(len(a), np.int64)
    first[starts] = starts
    within = np.arange(len(a)) - np.maximum.accumulate(first)
    values = _BYTE[a]
    values[space] = 0
    values *= powers[np.minimum(within, len(powers) - 1)]
    return mixed(np.add.reduceat(values, starts) + lengths.astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word; long texts go in pieces cut at white space."""
    parts, at = [], 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        parts.append(_word_hashes(text[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingles of the lower-cased text (A-Z only); fewer words than five are one shingle."""
    words = word_hashes((text or "").encode().lower())
    n = len(words)
    if not n:
        return words
    k = min(n, WORDS)
    sums = sum(words[i : n - k + 1 + i] * _WORD[i] for i in range(k))
    return np.unique(mixed(sums + np.uint64(k)))


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    one, two = mixed(shingles), mixed(shingles ^ np.uint64(0x5851F42D4C957F2D))
    return np.array([one.sum(dtype=np.uint64), two.sum(dtype=np.uint64)], ">u8").tobytes()
