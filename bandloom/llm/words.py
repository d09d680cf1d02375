"""Words of whole Arrow text columns as numpy arrays, without a Python object per word.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. A word's hash is a sum of pseudo-random numbers, one for
each of its bytes and places, so no pattern of bytes makes words collide; hashes of word runs are polynomials of the
word hashes. They are hashes all the same: what is decided by them alone is said where it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()
STEP, WORD_BASE, WINDOW_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
SLICE_BYTES = 2 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if offsets else np.zeros(len(col) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes, one text at least."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, b
        a = b


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text (one more entry than texts)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    space = SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offs[:-1][offs[:-1] < n]] = True
    after[offs[1:][offs[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    return starts, np.flatnonzero(~space & after) + 1, np.searchsorted(starts, offs)


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n at least; kept between batches."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size, out = 1 << max(16, int(n - 1).bit_length()), []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[base] = tuple(out)
    return _POWERS[base]


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Mixed polynomial hash of values[start:end] for each span; equal spans get equal hashes."""
    up, down = powers(base, len(values) + 1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def random_of(codes: np.ndarray) -> np.ndarray:
    """A pseudo-random number for each code."""
    return mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(STEP))


#: Numbers of the bytes at a word's first PLACES places, by place and byte.
PLACES = 64
NUMBERS = random_of(np.arange(PLACES << 8))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(starts[0], ends[-1]) - np.repeat(starts, np.diff(np.append(starts, ends[-1])))
    code = place << 8 | data[starts[0] : ends[-1]]
    sums = np.empty(len(code) + 1, np.uint64)
    sums[0] = 0
    numbers = NUMBERS.take(code, mode="clip")
    far = np.flatnonzero(place >= PLACES)
    numbers[far] = random_of(code[far])
    np.cumsum(numbers, out=sums[1:])
    return mix(sums[ends - starts[0]] - sums[starts - starts[0]] + (ends - starts).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, first: np.ndarray, n: int, base: int = WORD_BASE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one text, and the first gram of each text."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    at = np.concatenate([[0], np.cumsum(counts)])
    starts = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], counts)
    return spans_hash(hashes, starts, starts + n, base), at


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i:i+width] for each i that has so many."""
    out, have = values, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out
