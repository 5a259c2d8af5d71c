"""Shingle sets and circulant MinHash signatures of texts, in numpy.

A helper for the tasks of :mod:`rungworks.llm.minhash`.  Words are hashed for many texts at
once, straight from their bytes; sets and signatures are made text by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

#: Coordinates of a signature; bands take ROWS of them each.
COORDINATES = 128
ROWS = 4
#: Bytes of text that are hashed at once (a longer text is taken by itself).
CHUNK = 1 << 20

_U = np.uint64
_SHIFTS = np.arange(COORDINATES, dtype=np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers with good avalanche."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _odd(n: int, seed: int) -> np.ndarray:
    """Random odd multipliers for ``n`` places."""
    return mixed(np.arange(n, dtype=_U) + _U(seed)) | _U(1)


_BYTE = mixed(np.arange(256, dtype=_U) + _U(7_000_001))
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_IN_WORD = _odd(4096, 11_000_003)
_IN_SHINGLE = _odd(64, 13_000_007)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte's place of every word; A-Z count as a-z."""
    inside = ~_IS_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, dtype=_U), starts
    lengths = ends - starts
    places = np.flatnonzero(inside)
    within = np.arange(len(places)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    longest = int(lengths.max())
    factors = _IN_WORD if longest <= len(_IN_WORD) else _odd(longest, 11_000_003)
    terms = _BYTE[data[places]] * factors[within]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    return mixed(sums + lengths.astype(_U)), starts


def shingle_sets(texts: Sequence[bytes], width: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``width`` words.

    A-Z are lower-cased, words end at ASCII white space.  Fewer words than ``width`` make
    one shingle, no words make none.
    """
    start = 0
    while start < len(texts):
        stop, size = start + 1, len(texts[start])
        while stop < len(texts) and size + len(texts[stop]) < CHUNK:
            size += len(texts[stop])
            stop += 1
        yield from _sets_of(texts[start:stop], width)
        start = stop


def _sets_of(texts: Sequence[bytes], width: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    hashed, places = _word_hashes(data)
    edges = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    first = np.searchsorted(places, edges)
    n = max(0, len(hashed) - width + 1)
    total = np.zeros(n, dtype=_U)
    for i in range(width):
        total += hashed[i : i + n] * _IN_SHINGLE[i]
    total = mixed(total)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(total[a : b - width + 1])
        elif b > a:
            few = (hashed[a:b] * _IN_SHINGLE[width : width + b - a]).sum(dtype=_U, keepdims=True)
            yield mixed(few + _U(b - a))
        else:
            yield np.empty(0, dtype=_U)


def signature(shingles: np.ndarray, seed: int = 1) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least of ``pi(sigma(x) + k)`` over the set.

    ``sigma`` scatters the shingles over a circle of 2**32 places, ``pi`` orders the
    places, and each coordinate looks at the circle shifted by one place more: two
    permutations serve all coordinates.
    """
    places = mixed(shingles ^ _U(0xD1B54A32D192ED03 * seed % 2**64)).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(places), 1024):
        x = places[start : start + 1024, None] + _SHIFTS
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    rows = least[: bands * ROWS].reshape(bands, ROWS).astype(_U)
    key = _odd(bands, 17_000_023)
    for i in range(ROWS):
        key = mixed(key + rows[:, i] * _IN_SHINGLE[i])
    return key.view(np.int64)


def sketch(least: np.ndarray) -> np.ndarray:
    """Two bits of each coordinate, as four longs: close texts differ in few bits."""
    bits = np.concatenate([least & np.uint32(1), (least >> np.uint32(1)) & np.uint32(1)]).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view(np.int64)


def set_digest(shingles: np.ndarray) -> str:
    """128 bits that name the set, in hexadecimal."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether ``100 * |a & b| >= percent * |a | b|``, of sorted distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum()) if len(large) else 0
    return 100 * both >= percent * (len(a) + len(b) - both)
