"""Words of whole Arrow batches as 64-bit hashes, without a Python loop over words.

A word is a run of bytes other than space and \\x09-\\x0D, which in UTF-8 never cuts a character.
"""

from __future__ import annotations

import numpy as np

#: Odd multipliers; the inverse undoes a power of the first. Every task must hash alike.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1
#: Bytes that are hashed at a time.
SLICE = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A finalizer: every bit of the result depends on every bit of the argument."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: The same with A-Z as a-z.
FOLDED = LETTERS.copy()
FOLDED[ord("A") : ord("Z") + 1] = LETTERS[ord("a") : ord("z") + 1]


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up: np.ndarray = np.zeros(0, np.uint64)
    down: np.ndarray = np.zeros(0, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_Powers.up) < n:
        size = max(n, SLICE + (SLICE >> 2))
        _Powers.up, _Powers.down = powers(BASE, size), powers(INVERSE, size)
    return _Powers.up, _Powers.down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray = LETTERS) -> np.ndarray:
    """A hash of the bytes of each span (in order, not overlapping), made slice by slice."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, first + SLICE, side="right")))
        part = letters[data[first : int(ends[to - 1])]]
        up, down = _powers(len(part) + 1)
        part *= up[: len(part)]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(part, out=sums[1:])
        a, b = starts[at:to] - first, ends[at:to] - first
        out[at:to] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        at = to
    return mixed(out)


def word_spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (one more than texts).
    ``outside`` tells for each byte whether it parts words."""
    inside = ~outside[data]
    first, last = np.empty(len(data), bool), np.empty(len(data), bool)
    if len(data):
        first[0], first[1:] = True, ~inside[:-1]
        last[-1], last[:-1] = True, ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        first[edges], last[edges - 1] = True, True
    starts = np.flatnonzero(inside & first)
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def joined(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive entries, by doubling; empty if there are fewer."""
    have, width, out, done = h, 1, None, 0
    while True:
        if n & width:
            if out is None:
                out, done = have, width
            else:
                k = len(h) - done - width + 1
                if k <= 0:
                    return np.zeros(0, np.uint64)
                out = out[:k] * np.uint64(pow(STEP, width, 1 << 64)) + have[done : done + k]
                done += width
        if done == n:
            return mixed(out[: max(0, len(h) - n + 1)])
        k = len(h) - 2 * width + 1
        if k <= 0:
            return np.zeros(0, np.uint64)
        have = have[:k] * np.uint64(pow(STEP, width, 1 << 64)) + have[width : width + k]
        width *= 2


def within(text_of_first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For texts of words ``text_of_first[i]`` up to the next: the position in the whole array of every run of
    ``n`` words that lies in one text, and the text's index."""
    counts = np.maximum(0, np.diff(text_of_first) - n + 1)
    which = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    starts = text_of_first[:-1]
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)
    return at, which
