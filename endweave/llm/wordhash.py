"""Word and shingle hashes of whole Arrow string columns, by array operations on their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on together; a longer text is worked on alone.
CHUNK = 1 << 18

_M = np.uint64(0x9E3779B97F4A7C15)
_P = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = ((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407)) ^ np.uint64(0x9FB21C651E98DF25)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64, by doubling."""
    out = np.ones(n, dtype=np.uint64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done += more
        step = step * step % (1 << 64)
    return out


class _Powers:
    """Powers of the multiplier and of its inverse, kept while a worker lives."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            up, down = _powers(_P, n), _powers(_P_INV, n)
            if n > 4 * CHUNK:  # one very long text; nothing that large is kept
                return up, down
            cls.up, cls.down = up, down
        return cls.up[:n], cls.down[:n]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about CHUNK bytes.

    Null strings count as empty.
    """
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words of all rows, and the words of each row."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(rows, dtype=np.int64)
    inner = ~_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    start = inner.copy()
    start[1:] &= ~inner[:-1] | first[1:-1]
    end = inner.copy()
    end[:-1] &= ~inner[1:] | first[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _Powers.of(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[_LOWER[data] if fold else data] * up, out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    value = mix64(value + (ends - starts).astype(np.uint64) * _M)
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return value, counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row, with repeats, and the shingles of each row.

    A row of fewer words than k, one at least, has one shingle: all its words.
    """
    counts = np.asarray(counts, dtype=np.int64)
    out_counts = np.where(counts == 0, 0, np.maximum(counts - k + 1, 1))
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64), out_counts
    row_start = np.concatenate([[0], np.cumsum(counts)])[:-1]
    total = int(out_counts.sum())
    row = np.repeat(np.arange(len(counts)), out_counts)
    first = np.concatenate([[0], np.cumsum(out_counts)])[:-1]
    at = row_start[row] + (np.arange(total) - first[row])
    size = np.minimum(counts, k)[row]
    value = np.full(total, 0x51ED270B0A1F39C1, dtype=np.uint64)
    for i in range(k):
        inside = size > i
        value = np.where(inside, mix64(value + words[np.minimum(at + i, n - 1)] * _M), value)
    return mix64(value ^ size.astype(np.uint64)), out_counts


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for every row of a string column."""
    for at, to, data, offsets in chunks(column):
        words, counts = word_hashes(data, offsets)
        values, per = shingle_hashes(words, counts, k)
        ends = np.cumsum(per)
        for i in range(to - at):
            yield at + i, np.unique(values[ends[i] - per[i] : ends[i]])
