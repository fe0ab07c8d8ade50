"""Simple-8b word-aligned integer coding, vectorised over whole blocks.

A 64-bit word holds a 4-bit selector (top bits) and 60 data bits; the selector says
how many values of which width the word packs (first value in the lowest bits). A
value of 60 bits or more is escaped: a word with the escape selector, then the raw
value as a word of its own.
"""

from __future__ import annotations

import numpy as np

# Selector -> (values per word, bits per value). Selectors 0 and 1 hold runs of zeros.
LAYOUT = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
          (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
#: Selector 0 with data bits all set marks an escape: the next word is the raw value.
ESCAPE = np.uint64((1 << 60) - 1)
_COUNT = np.array([c for c, _ in LAYOUT], dtype=np.int64)


_SHORT = np.concatenate(([0], np.floor(np.log2(np.arange(1, 1 << 16))) + 1)).astype(np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each value (0 for 0), by 16-bit pieces."""
    width = _SHORT[values & np.uint64(0xFFFF)]
    for shift in (16, 32, 48):
        rest = values >> np.uint64(shift)
        big = np.flatnonzero(rest)
        if not len(big):
            break
        width[big] = _SHORT[rest[big] & np.uint64(0xFFFF)] + shift
    return width


def _selectors(width: np.ndarray) -> np.ndarray:
    """Per position, the selector that packs the most values from there on."""
    n = len(width)
    best = np.full(n, 15, dtype=np.uint8)
    top, size = width, 1  # maxima over windows of ``size`` values, by doubling
    for selector in range(14, -1, -1):
        count, bits = LAYOUT[selector]
        if count > n:
            break
        while size * 2 <= count:
            top = np.maximum(top[:-size], top[size:])
            size *= 2
        window = np.maximum(top[:n - count + 1], top[count - size:][:n - count + 1])
        fits = window <= bits
        if not bits and not fits.any():
            break
        head = best[:len(fits)]
        np.minimum(head, np.where(fits, np.uint8(selector), np.uint8(15)), out=head)
    return best


def encode(values: np.ndarray) -> np.ndarray:
    """Values (unsigned integers) as 64-bit words."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    # 16-bit ids stay narrow until they are shifted into their words.
    width = _SHORT[values] if values.dtype == np.uint16 else _bits(values.astype(np.uint64))
    selector = _selectors(width)
    escaped = width > 60
    step = _COUNT[selector].astype(np.uint8).tobytes()
    starts = []
    at = 0
    while at < n:  # greedy: each word begins where the last one ended
        starts.append(at)
        at += step[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = selector[starts]
    raw = escaped[starts]
    place = np.arange(len(starts)) + np.concatenate(([0], np.cumsum(raw)[:-1]))
    words = np.zeros(len(starts) + int(raw.sum()), dtype=np.uint64)
    data = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        count, bits = LAYOUT[s]
        rows = np.flatnonzero(chosen == s)
        if not bits:
            continue
        begin = starts[rows]
        packed = np.zeros(len(rows), dtype=np.uint64)
        for i in range(count):
            packed |= values[begin + i].astype(np.uint64) << np.uint64(i * bits)
        data[rows] |= packed & ESCAPE
    words[place] = np.where(raw, ESCAPE, data)
    words[place[raw] + 1] = values[starts[raw]]
    return words


def decode(words: np.ndarray) -> np.ndarray:
    """The values of a block of whole words."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    if not len(words):
        return np.zeros(0, np.uint64)
    # A raw word may look like an escape itself: walk the (rare) candidates in order.
    escape = np.zeros(len(words), dtype=bool)
    last = -2
    for i in np.flatnonzero(words == ESCAPE):
        if i != last + 1:
            escape[i] = True
            last = i
    raw = np.concatenate(([False], escape[:-1]))
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.where(escape, 0, np.where(raw, 1, _COUNT[selector]))
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]), dtype=np.uint64)
    first = ends - counts
    out[first[raw]] = words[raw]
    plain = ~(escape | raw)
    for s in np.unique(selector[plain]):
        count, bits = LAYOUT[s]
        if not bits:
            continue
        rows = np.flatnonzero(plain & (selector == s))
        low = np.uint64((1 << bits) - 1)
        for i in range(count):
            out[first[rows] + i] = (words[rows] >> np.uint64(i * bits)) & low
    return out
