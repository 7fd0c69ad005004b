"""Hashes of the words and n-grams of Arrow string columns, vectorised with numpy.

All functions run inside tasks on one Arrow batch.  A word's hash is a
polynomial over a random value per byte, modulo 2**64, then mixed; word hashes
are taken segment by segment, so the working memory does not follow the length
of a text except for one word longer than a segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser of unsigned 64-bit values."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values, the same on every executor."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0xD1B54A32D192ED03) + U(seed))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.cumprod(out)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = _powers(base, max(n, SEGMENT + 1))
        if n <= SEGMENT + 1:
            _POWERS[base] = have
    return have[:n]


def byte_values(fold_ascii: bool) -> np.ndarray:
    v = randoms(256, 7)
    if fold_ascii:
        v[65:91] = v[97:123]
    return v


def white_space() -> np.ndarray:
    """Bytes 0x20 and 0x09-0x0D."""
    sep = np.zeros(256, dtype=bool)
    sep[[0x20, *range(0x09, 0x0E)]] = True
    return sep


def ascii_breaks() -> np.ndarray:
    """Every ASCII byte that is neither a letter nor a digit."""
    sep = np.zeros(256, dtype=bool)
    sep[:128] = [not chr(i).isalnum() for i in range(128)]
    return sep


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the n + 1 offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``size`` bytes; a longer row is alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, size: int = 2 << 20, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``size`` bytes of a string column and at most ``rows`` rows; a longer text is alone."""
    for batch in batches:
        if not len(batch):
            yield batch
        _, off = column_bytes(batch.column(column))
        for lo, hi in slices(off, size):
            for a in range(lo, hi, rows):
                yield batch.slice(a, min(rows, hi - a))


def _segment(buf: np.ndarray, cuts: np.ndarray, sep: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~sep[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    if len(cuts):  # a row ends before each cut
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum(value[buf] * powers(_BASE, len(buf)), out=sums[1:])
    h = (sums[e] - sums[s]) * powers(_INVERSE, len(buf) + 1)[s]
    return s, mix(h ^ (e - s).astype(U))


def word_hashes(buf: np.ndarray, offsets: np.ndarray, sep: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of the rows in ``buf``, and the n + 1 bounds of the rows' words.  No word crosses rows."""
    starts, hashes, a, n = [], [], 0, len(buf)
    while a < n:
        b = min(a + SEGMENT, n)
        if b < n:
            tail = np.flatnonzero(sep[buf[a:b]])
            row = offsets[max(np.searchsorted(offsets, b, side="right") - 1, 0)]
            back = max(a + tail[-1] + 1 if len(tail) else a, row)
            if back > a:
                b = int(back)
            else:  # one word longer than a segment
                ahead = offsets[np.searchsorted(offsets, b)]
                step = b
                while step < ahead:
                    found = np.flatnonzero(sep[buf[step:step + SEGMENT]])
                    if len(found):
                        ahead = min(ahead, step + found[0])
                        break
                    step += SEGMENT
                b = int(ahead)
        lo, hi = np.searchsorted(offsets, [a, b], side="right")
        cuts = offsets[lo:hi] - a
        s, h = _segment(buf[a:b], cuts[(cuts > 0) & (cuts < b - a)], sep, value)
        starts.append(s + a)
        hashes.append(h)
        a = b
    if not starts:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words; runs that cross rows are in it and not to be used."""
    if len(words) < n:
        return np.zeros(0, U)
    c = randoms(n, 11) | U(1)
    out = np.zeros(len(words) - n + 1, dtype=U)
    for j in range(n):
        out += words[j:len(words) - n + 1 + j] * c[j]
    return mix(out)


def short_hash(words: np.ndarray) -> np.ndarray:
    """One hash of a whole sequence that is shorter than an n-gram."""
    c = randoms(len(words), 13) | U(1)
    return mix(np.array([np.sum(words * c, dtype=U) + U(len(words))], dtype=U))


def row_grams(words: np.ndarray, bounds: np.ndarray, grams: np.ndarray, row: int, n: int) -> np.ndarray:
    """The n-gram hashes of a row in order; of fewer words, the whole sequence as one; of none, nothing."""
    lo, hi = bounds[row], bounds[row + 1]
    if hi - lo >= n:
        return grams[lo:hi - n + 1]
    return short_hash(words[lo:hi]) if hi > lo else grams[:0]
