"""Vectorised text helpers shared by the operators: words and their hashes over Arrow string batches.

Everything works on one bounded slice of a batch at a time (``slices``), so a task holds arrays
proportional to ``SLICE_BYTES`` or to one text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE_BYTES = 1 << 20

#: ASCII white space: space and the characters 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z; every other byte stays.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective): every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)  # a 64-bit value for each byte


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_pow_cache = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse (grown once, then shared)."""
    if len(_pow_cache[0]) < n:
        size = max(n, 2 * len(_pow_cache[0]))
        _pow_cache[0], _pow_cache[1] = _powers(int(_ODD), size), _powers(int(_INVERSE), size)
    return _pow_cache[0][:n], _pow_cache[1][:n]


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each ``values[start:end]`` from prefix sums: equal spans have equal hashes wherever they stand."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def span_hash_without(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Hash of each ``values[start:end]`` without the value at ``gone``: what ``span_hash`` gives the shorter span."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    h = (total[gone] - total[starts]) * down[starts] + (total[ends] - total[gone + 1]) * down[starts + 1]
    return mix(h + (ends - starts - 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text each; one longer text is a range of its own."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield at, stop
        at = stop


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a slice, and where each text ends; null counts as empty."""
    texts = pa.concat_arrays([pa.compute.fill_null(texts, "").cast(pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    return data, offsets[1:] - offsets[0]


def words(data: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each maximal run without ASCII white space, and how many words stand before each
    text's end (words never cross texts)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(text_ends), np.int64)
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = text_ends[(text_ends > 0) & (text_ends < len(data))]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, text_ends, "left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    return span_hash(_BYTE[ASCII_LOWER[data] if lower else data], starts, ends)
