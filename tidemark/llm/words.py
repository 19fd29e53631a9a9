"""Words, shingles and hashes of many texts at once, as numpy arrays. White space is U+0020 and U+0009 to U+000D.

A word's hash is a polynomial in its bytes modulo 2**64 (A-Z lower-cased), mixed with its length; hashes of different
words are taken as different.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
SEGMENT = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def salt(n: int) -> np.uint64:
    """The n-th of a fixed series of odd numbers."""
    with np.errstate(over="ignore"):
        return mix(np.array([n + 1], dtype=U) * BASE)[0] | U(1)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins; a null text is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    every = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def is_space(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b >= 9) & (b <= 13))


def word_spans(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after it; a word never goes past its text."""
    space = is_space(b)
    first = ~space
    first[1:] &= space[:-1]
    last = ~space
    last[:-1] &= space[1:]
    starts, ends = offsets[:-1], offsets[1:]
    full = starts[ends > starts]
    first[full] = ~space[full]
    last[ends[ends > starts] - 1] = ~space[ends[ends > starts] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of BASE and of its inverse from 0 to n."""
    bases = np.full((2, n + 1), BASE, dtype=U)
    bases[1] = BASE_INVERSE
    bases[:, 0] = 1
    return tuple(np.cumprod(bases, axis=1))


@cache
def _segment_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(SEGMENT)


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span. Spans are in order and do not overlap; worked on a segment at a time."""
    out = np.empty(len(starts), dtype=U)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(ends, starts[at] + SEGMENT, side="right")), at + 1)
        lo, hi = starts[at], ends[to - 1]
        powers, inverse = _segment_powers() if hi - lo <= SEGMENT else _powers(hi - lo)
        sums = np.zeros(hi - lo + 1, dtype=U)
        np.cumsum((b[lo:hi].astype(U) + U(1)) * powers[: hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U) * salt(99))
        at = to
    return out


def lowered(b: np.ndarray) -> np.ndarray:
    """A-Z as a-z, nothing else changed."""
    return np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words; of all its words if there are fewer."""
    b, offsets = flat(texts)
    b = lowered(b)
    starts, ends = word_spans(b, offsets)
    words = span_hashes(b, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    runs = np.zeros(len(words), dtype=U)
    for j in range(size):
        runs[: len(words) - j] += words[j:] * salt(j)
    runs = mix(runs)
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        n = hi - lo
        if n >= size:
            out.append(np.unique(runs[lo : hi - size + 1]))
        elif n:
            whole = (words[lo:hi] * np.array([salt(j) for j in range(n)], dtype=U)).sum(keepdims=True)
            out.append(mix(whole ^ salt(100 + int(n))))
        else:
            out.append(np.zeros(0, dtype=U))
    return out
