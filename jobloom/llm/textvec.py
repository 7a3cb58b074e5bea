"""Words and word windows of whole texts as 64-bit hashes, computed over byte
arrays. Slices of documents bound the memory; a window never leaves its text.

A word's hash takes 8 of its bytes at a time: each step is a bijective mix of the
state with the next 8, so words of up to 8 bytes have different hashes if they have
the same length, and no arithmetic structure of longer ones carries over. Words of
more than LONG bytes are hashed by BLAKE2. A second lane, where it is asked for, is
a chain of its own with other constants."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

U = np.uint64
_P = U(0x9E3779B97F4A7C15)
_Q = U(0xC2B2AE3D27D4EB4F)
_SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
#: The bytes of a word that are left over, from 0 to 8 of them.
_LEFT = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
LONG = 64
#: Of each lane the step, and the state that a word of each length begins with.
_STEPS = (_P, U(0xD6E8FEB86659FD93))
_STARTS = tuple(mix(np.arange(LONG + 1, dtype=U) * step + start) for step, start in zip(_STEPS, (U(0x2545F4914F6CDD1D), U(0x9FB21C651E98DF25)), strict=True))


def _slice(raw: list[bytes], fold: bool, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(raw) + b"\n" + bytes(8), np.uint8)
    blank = _BLANK[data]
    blank[-8:] = True
    if fold:
        data = _FOLDED[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    begin, size = edge[::2], edge[1::2] - edge[::2]
    eight = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), 0, (1,))
    hashes = np.empty((lanes, len(begin)), U)
    short = np.minimum(size, LONG)
    chunk = eight[begin] & _LEFT[np.minimum(size, 8)]
    for lane in range(lanes):
        hashes[lane] = mix((_STARTS[lane][short] ^ chunk) * _STEPS[lane])
    every = np.flatnonzero((size > 8) & (size <= LONG))
    at, left = begin[every] + 8, size[every] - 8
    while len(every):
        chunk = eight[at] & _LEFT[np.minimum(left, 8)]
        for lane in range(lanes):
            hashes[lane, every] = mix((hashes[lane, every] ^ chunk) * _STEPS[lane])
        more = left > 8
        every, at, left = every[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG).tolist():
        own = blake2b(data[begin[i] : begin[i] + size[i]].tobytes(), digest_size=16).digest()
        hashes[:, i] = np.frombuffer(own, U)[:lanes]
    limits = np.cumsum([0] + [len(x) + 1 for x in raw])
    return hashes, np.searchsorted(begin, limits)


def words(texts: list[str], fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the total)."""
    hashes, first = wide_words(texts, fold, 1)
    return hashes[0], first


def wide_words(texts: list[str], fold: bool, lanes: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """words() with `lanes` independent hashes of each word, a row each."""
    hashes, firsts, at = [np.empty((lanes, 0), U)], [np.zeros(1, np.int64)], 0
    for raw in _slices(texts):
        h, first = _slice(raw, fold, lanes)
        hashes.append(h)
        firsts.append(first[1:] + at)
        at += h.shape[1]
    return np.concatenate(hashes, axis=1), np.concatenate(firsts).astype(np.int64)


def _slices(texts: list[str]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        if part and size + len(raw) > _SLICE:
            yield part
            part, size = [], 0
        part.append(raw)
        size += len(raw) + 1
    if part:
        yield part


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the width words from each place on; of places too near the end, none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, U)
    total = hashes[:n].copy()
    for k in range(1, width):
        total *= _Q
        total += hashes[k : k + n]
    return mix(total)


def inside(first: np.ndarray, width: int) -> np.ndarray:
    """Whether the window from each place on stays in its text, for windows()."""
    n = int(first[-1]) - width + 1
    if n <= 0:
        return np.empty(0, bool)
    left = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)
    return left >= width
