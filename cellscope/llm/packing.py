"""Short byte strings as one or two uint64 words, their radix sort and run counts, in numpy."""

from __future__ import annotations

import numpy as np

SHORT = 16      # bytes that two words hold
_KEEP = np.array([0] + [(1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9)], np.uint64)


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of True that don't cross the row bounds ``offsets``."""
    begin, stop = mask.copy(), mask.copy()
    begin[1:] &= ~mask[:-1]
    stop[:-1] &= ~mask[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(mask))]
    begin[edges] |= mask[edges]
    stop[edges - 1] |= mask[edges - 1]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def packed(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes ``start:start + length`` (at most SHORT, none of them 0) as two words, the first
    byte highest and zeros behind: words order as the bytes do.  The second is 0 for up to 8."""
    padded = np.concatenate([data, np.zeros(SHORT, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1))
    high = eight[start].view(">u8").ravel().astype(np.uint64) & _KEEP[np.minimum(length, 8)]
    low = np.zeros(len(start), np.uint64)
    long = np.flatnonzero(length > 8)
    low[long] = eight[start[long] + 8].view(">u8").ravel().astype(np.uint64) & _KEEP[length[long] - 8]
    return high, low


def unpacked(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of packed words one after the other, and their offsets."""
    both = np.stack([high, low], 1).astype(">u8").view(np.uint8).reshape(len(high), SHORT)
    there = both != 0
    return both[there], np.concatenate([[0], np.cumsum(there.sum(1))])


def radix_order(keys: list[np.ndarray], order: np.ndarray | None = None) -> np.ndarray:
    """Stable order by ``keys``, unsigned and the most significant last, beginning with
    ``order``: one pass for each 16-bit digit in which the keys differ."""
    n = len(keys[0])
    order = np.arange(n) if order is None else order
    for key in keys:
        if not n:
            break
        differ = int(np.bitwise_or.reduce(key ^ key[0]))
        for shift in range(0, 8 * key.itemsize, 16):
            if differ >> shift & 0xFFFF:
                digit = (key >> key.dtype.type(shift)).astype(np.uint16)
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Places where a run of rows that are equal in all (sorted) columns begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(columns[0]), bool)
    new[1:] = columns[0][1:] != columns[0][:-1]
    for c in columns[1:]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)
