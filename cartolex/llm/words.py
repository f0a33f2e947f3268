"""Words and word shingles of Arrow string columns, hashed with numpy.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; A-Z count as a-z, other letters as they
are. Everything works on the column's UTF-8 buffer, in slices of bounded size, so a batch of long
documents needs no more memory than one slice (or than its longest document).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_rng = np.random.RandomState(20240229)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = _rng.randint(1, 2**62, 256, dtype=np.int64).astype(_U)
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_UNBASE = _U(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=_U)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit changes each output bit about half the time."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` of runs of rows of about ``limit`` bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    ends = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + limit, "right")) - 1)
        yield i, j, data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
        i = j


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and for each text the index of its first word (one more at the end)."""
    n = len(data)
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's lower-cased bytes."""
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLICE_BYTES // 4)))
        low, high = starts[i], ends[j - 1]
        power, unpower = _power_tables(int(high - low) + 1)
        total = np.zeros(high - low + 1, _U)
        np.cumsum(_BYTE[_LOWER[data[low:high]]] * power[: high - low], out=total[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((total[b] - total[a]) * unpower[a] + (b - a).astype(_U))
        i = j
    return out


def shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` words in a row, and each text's first index into them.

    A text of fewer words has one shingle, its whole sequence; one without words has none.
    """
    factor = mix(np.arange(1, 2 * width + 1, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)
    counts = np.diff(first)
    n = len(words)
    made = np.zeros(max(n - width + 1, 0), _U)
    for k in range(width):
        made += words[k : k + len(made)] * factor[k]
    made = mix(made)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    where = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(first[:-1] - where[:-1], sizes) + np.arange(where[-1])
    short = np.flatnonzero((counts > 0) & (counts < width))
    keep = np.repeat(counts >= width, sizes)
    out = np.zeros(where[-1], _U)
    out[keep] = made[at[keep]]
    for k in range(1, width):
        of = short[counts[short] == k]
        if len(of):
            total = np.full(len(of), factor[width + k - 1], _U)
            for i in range(k):
                total += words[first[of] + i] * factor[i]
            out[where[of]] = mix(total ^ _U(k))
    return out, where


def distinct_shingles(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For runs of rows: the first row, and each row's sorted distinct shingle hashes."""
    for row, _, data, offsets in slices(column):
        starts, ends, first = spans(data, offsets)
        made, where = shingles(hashes(data, starts, ends), first, width)
        sets = []
        for a, b in zip(where[:-1], where[1:], strict=True):
            u = np.sort(made[a:b])
            if len(u) > 1:
                u = u[np.concatenate(([True], u[1:] != u[:-1]))]
            sets.append(u)
        yield row, sets


#: Byte classes of :func:`runs`: 0 white space, 1 letters and all bytes of other scripts, 2 digits, 3 the rest.
CLASSES = np.full(256, 3, np.uint8)
CLASSES[_SPACE] = 0
CLASSES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
CLASSES[48:58] = 2


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like :func:`spans`, for the longest runs of bytes of one class (white space left out)."""
    kind = CLASSES[data]
    edge = np.ones(len(data), bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[offsets[offsets < len(data)]] = True
    begins = np.flatnonzero(edge)
    ends = np.append(begins[1:], len(data))
    keep = kind[begins] != 0
    starts = begins[keep]
    return starts, ends[keep], np.searchsorted(starts, offsets)
