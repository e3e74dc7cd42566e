"""Simple-8b: runs of non-negative integers packed into 64-bit words.

The top four bits of a word are its selector; the other sixty hold as many equally wide values as the selector says, the
first in the lowest bits. Selectors 0 and 1 stand for 240 and 60 zeros and need no bits. Selector 15 is the escape: the low bits
count the raw 64-bit values that follow it, for values of more than 60 bits. The last word of a block may be filled up with zeros; the
block's length says how many values are real.

Decoding takes all words of one selector at a time, so it is as vectorised as the number of selectors allows.
"""

from __future__ import annotations

from array import array

import numpy as np

#: Values per word and bits per value, by selector; 15 is the escape.
COUNTS = np.array([240, 60, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 3, 2, 1, 0])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 20, 30, 60, 64])
ESCAPE = 15
_STEPS = bytes(max(int(c), 1) for c in COUNTS).ljust(256, b"\1")
_PAYLOAD = np.uint64(60)


_TABLE = np.unique(WIDTHS)
_LIMITS = np.array([(1 << int(w)) - 1 for w in _TABLE if w < 64], np.uint64)
#: The least width for each small value, looked up.
_SMALL = _TABLE[np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64))].astype(np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """The least width of the table that holds each value (64 for those that need the escape)."""
    if int(values.max()) < len(_SMALL):
        return _SMALL[values]
    return _TABLE[np.searchsorted(_LIMITS, values)].astype(np.uint8)


def encode(values: np.ndarray) -> np.ndarray:
    """The words of one block of unsigned integers (none for an empty block)."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64)
    need = _widths(values)
    choice = np.full(n, ESCAPE, np.uint8)
    # widest[i]: the largest width among the ``size`` values from i on; past the end nothing is needed.
    widest, size = need, 1
    for selector in range(14, -1, -1):  # from one value a word to many: what fits a denser selector fits all before it
        count = int(COUNTS[selector])
        while 2 * size <= count:
            moved = np.zeros(n, np.uint8)
            moved[:max(0, n - size)] = widest[size:]
            widest, size = np.maximum(widest, moved), 2 * size
        fits = widest <= WIDTHS[selector]
        if not fits.any():
            continue
        if shift := count - size:  # also the values that the first ``size`` leave out
            fits[:max(0, n - shift)] &= fits[shift:]
        choice -= fits.view(np.uint8)
    steps, picked, at = choice.tobytes().translate(_STEPS), array("q"), 0
    while at < n:
        picked.append(at)
        at += steps[at]
    starts = np.frombuffer(picked, np.int64)
    selectors = choice[starts]
    escapes = selectors == ESCAPE
    # Neighbouring escapes share one header word.
    first = escapes & ~np.concatenate([[False], escapes[:-1]])
    places = np.cumsum(1 + first) - 1  # of each word; an escape's raw value follows its header
    out = np.zeros(int(places[-1]) + 1, np.uint64)
    padded = np.concatenate([values, np.zeros(240, np.uint64)])
    for selector in np.unique(selectors[~escapes]):
        own = selectors == selector
        begin = starts[own]
        word = np.full(len(begin), np.uint64(selector) << _PAYLOAD, np.uint64)
        width = int(WIDTHS[selector])
        for k in range(int(COUNTS[selector]) if width else 0):
            word |= padded[k:][begin] << np.uint64(k * width)
        out[places[own]] = word
    if escapes.any():
        out[places[escapes]] = values[starts[escapes]]
        run = np.cumsum(first)[escapes]
        header = places[first] - 1
        out[header] = (np.uint64(ESCAPE) << _PAYLOAD) | np.bincount(run)[1:].astype(np.uint64)
    return out


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of one block."""
    words = np.ascontiguousarray(words, np.uint64)
    if not n:
        return np.empty(0, np.uint64)
    selectors = (words >> _PAYLOAD).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (selectors == ESCAPE).any():
        at = 0
        headers = np.flatnonzero(selectors == ESCAPE)
        for header in headers:
            if header >= at:  # not itself a raw value
                at = int(header) + 1 + int(words[header] & np.uint64((1 << 60) - 1))
                raw[header + 1:at] = True
    counts = np.where(raw, 1, COUNTS[selectors])
    ends = np.cumsum(counts)
    out = np.zeros(max(int(ends[-1]), n), np.uint64)
    starts = ends - counts
    out[starts[raw]] = words[raw]
    for selector in np.unique(selectors[~raw]):
        width, count = int(WIDTHS[selector]), int(COUNTS[selector])
        if not width or selector == ESCAPE:
            continue
        own = ~raw & (selectors == selector)
        mask, word, begin = np.uint64((1 << width) - 1), words[own], starts[own]
        for k in range(count):
            out[begin + k] = (word >> np.uint64(k * width)) & mask
    return out[:n]
