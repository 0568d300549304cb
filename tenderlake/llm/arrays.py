"""Word splitting, hashing and packing on byte arrays, shared by the operators on texts.

All functions work on one bounded chunk of texts at a time and run inside Spark tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

CHUNK_BYTES = 2 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = {0x20, *range(0x09, 0x0E)}
#: A word byte by the definition "no blank" and by the definition "ASCII letter or digit, or not ASCII".
BLANK_SEPARATED = bytes(c not in _SPACE for c in range(256))
ALPHANUMERIC = bytes(c >= 0x80 or chr(c).isalnum() for c in range(256))

_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grow_powers(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        steps = np.full(n, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        _inverses = np.cumprod(steps)


@dataclass
class Words:
    """The words of several texts, one after the other; text i owns ``first[i]:first[i+1]``."""

    blob: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text(self, begin: int, stop: int) -> bytes:
        """Words ``begin`` to ``stop`` joined by one space."""
        return b" ".join(self.blob[s:e] for s, e in zip(self.start[begin:stop], self.end[begin:stop]))


def chunks(texts: Sequence, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8, at most about ``limit`` bytes at a time; a longer text stands alone."""
    at, size, part = 0, 0, []
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "replace") if isinstance(text, str) else b""
        if part and size + len(raw) > limit:
            yield at, part
            at, size, part = i, 0, []
        part.append(raw)
        size += len(raw)
    if part:
        yield at, part


def split_words(texts: list[bytes], word_bytes: bytes) -> Words:
    """Lower-case A-Z, cut into maximal runs of word bytes, and hash every word to 64 bits."""
    blob = (b" ".join(texts) + b" ").translate(_LOWER)
    inside = np.frombuffer(blob.translate(word_bytes), np.int8)
    edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
    start, end = edges[0::2], edges[1::2]
    _grow_powers(len(blob) + 1)
    sums = np.zeros(len(blob) + 1, np.uint64)
    np.cumsum((np.frombuffer(blob, np.uint8).astype(np.uint64) + np.uint64(1)) * _powers[: len(blob)], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * _inverses[start] + (end - start).astype(np.uint64))
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return Words(blob, start, end, np.searchsorted(start, bounds), hashes)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every ``width`` consecutive words; order matters."""
    n = max(len(hashes) - width + 1, 0)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        weight = pow(0xD6E8FEB86659FD93, j + 1, 1 << 64)
        total += hashes[j : j + n] * np.uint64(weight)
    return mix(total + np.uint64(width))


def pack(values: np.ndarray) -> bytes:
    """Compress an integer array: equal bytes of all values stand together."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(blob: bytes, dtype: type) -> np.ndarray:
    """Undo :func:`pack`."""
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Compress an ascending array of unsigned 64-bit integers by its differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


class Bloom:
    """Set of 64-bit integers that may also accept others; its size is bounded whatever it holds."""

    HASHES = 4
    MOST_BITS = 1 << 28

    def __init__(self, expected: int) -> None:
        bits = 1 << max(10, (max(expected, 1) * 12 - 1).bit_length())
        self.mask = np.uint64(min(bits, self.MOST_BITS) - 1)
        self.bits = np.zeros((int(self.mask) + 1) // 8, np.uint8)

    def _places(self, values: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(np.asarray(values).astype(np.uint64))
        step = mix(h + np.uint64(1)) | np.uint64(1)
        for _ in range(self.HASHES):
            yield h & self.mask
            h = h + step

    def add(self, values: np.ndarray) -> None:
        for at in self._places(values):
            np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def holds(self, values: np.ndarray) -> np.ndarray:
        found = np.ones(len(values), bool)
        for at in self._places(values):
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found
