"""Words of many texts at once, as 64-bit numbers in numpy arrays.

Words are runs of bytes other than space and 0x09-0x0D. A word's number is a
polynomial over its bytes with odd base, taken from running sums and mixed; two
words of one text collection share a number with probability about 2**-64 a pair.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from tracewell.llm.shared import text_bytes

PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15
SPACES = (0x20, *range(0x09, 0x0E))

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.zeros(256, bool)
_space[list(SPACES)] = True


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up, down = np.empty(PIECE + 1, np.uint64), np.empty(PIECE + 1, np.uint64)
    for out, base in ((up, BASE), (down, pow(BASE, -1, 1 << 64))):
        out[0], step = 1, 1
        while step < len(out):  # doubling: out[i + step] = out[i] * base**step
            n = min(step, len(out) - step)
            out[step:step + n] = out[:n] * np.uint64(pow(base, step, 1 << 64))
            step *= 2
    return up, down


def mix(numbers: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers, one to one."""
    x = numbers.astype(np.uint64, copy=True)
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (32, 0xD6E8FEB86659FD93)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(32)
    return x


def split_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _space) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in ``data``; no word reaches over a text's border."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = separators[data]
    before = np.empty_like(gap)
    before[0], before[1:] = True, gap[:-1]
    after = np.empty_like(gap)
    after[-1], after[:-1] = True, gap[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = True
    after[cuts - 1] = True
    word = ~gap
    return np.flatnonzero(word & before), np.flatnonzero(word & after) + 1


def number_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for the bytes of every span (sorted, not overlapping)."""
    up, down = _powers()
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = int(np.searchsorted(ends, low + PIECE, "right"))
        if j <= i:  # one span longer than a piece
            total, length = np.uint64(0), int(ends[i] - low)
            with np.errstate(over="ignore"):
                for at in range(0, length, PIECE):
                    part = data[low + at:min(low + at + PIECE, ends[i])].astype(np.uint64) + np.uint64(1)
                    total += np.sum(part * up[:len(part)], dtype=np.uint64) * np.uint64(pow(BASE, at, 1 << 64))
            out[i] = total
            i += 1
            continue
        high = ends[j - 1]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    return mix(out)


def words_of(text: pa.Array, lower: bool = True, separators: np.ndarray = _space):
    """(numbers, first, starts, ends, data): the words' numbers, where each text's words
    begin (one more entry than texts), and the words' places in the bytes ``data``."""
    data, offsets = text_bytes(text)
    if lower:
        data = _lower[data]
    starts, ends = split_words(data, offsets, separators)
    first = np.searchsorted(starts, offsets)
    return number_spans(data, starts, ends), first, starts, ends, data


def shingles_of(numbers: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all runs of ``size`` words, and the text each belongs to. A text of
    fewer words, but at least one, has one: its whole sequence."""
    counts = np.diff(first)
    n = len(numbers)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, n - size + 1), np.uint64)
        for i in range(size):
            rolled = rolled * np.uint64(BASE) + numbers[i:n - size + 1 + i]
        text = np.repeat(np.arange(len(counts)), counts)
        full = (text[:n - size + 1] == text[size - 1:]) if n >= size else np.zeros(0, bool)
        short = np.flatnonzero((counts > 0) & (counts < size))
        extra = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            has = counts[short] > i
            extra[has] = extra[has] * np.uint64(BASE) + numbers[first[short][has] + i]
        extra += counts[short].astype(np.uint64)
    return mix(np.concatenate([rolled[full], extra])), np.concatenate([text[:len(full)][full], short])
