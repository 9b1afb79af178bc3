"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a run of ASCII letters and digits and of any characters beyond ASCII, with A-Z
lower-cased; every other character separates words. All separators are single bytes, so the
UTF-8 bytes can be classified one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BYTE = np.arange(256)
_IS_WORD = (
    ((_BYTE >= 0x30) & (_BYTE <= 0x39))
    | ((_BYTE >= 0x41) & (_BYTE <= 0x5A))
    | ((_BYTE >= 0x61) & (_BYTE <= 0x7A))
    | (_BYTE >= 0x80)
)
_LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)

_PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_PRIME, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of a batch in order; ``first[d]:first[d + 1]`` are those of text d."""

    data: np.ndarray  # lower-cased bytes of the whole batch
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: a polynomial in its bytes, mixed."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(_PRIME, n), out=sums[1:])
        down = _powers(_INVERSE, n)
        return mix((sums[self.end] - sums[self.start]) * down[self.start])

    def strings(self, which: np.ndarray) -> list[str]:
        """Some words as strings."""
        raw = self.data.tobytes()
        return [
            raw[a:b].decode("utf-8", "replace")
            for a, b in zip(self.start[which].tolist(), self.end[which].tolist())
        ]


def words_of(texts: pa.Array) -> Words:
    """Words of the texts of a string array; a null has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    raw = np.frombuffer(data, np.uint8)[low:high] if data is not None else np.empty(0, np.uint8)
    ends = offsets[1:] - low if len(texts) else np.empty(0, np.int64)
    # A separator after every text keeps words from running into the next one.
    spaced = np.empty(len(raw) + len(ends), np.uint8)
    at = ends + np.arange(len(ends))
    body = np.ones(len(spaced), bool)
    body[at] = False
    spaced[at] = 0x20
    spaced[body] = _LOWER[raw]
    inside = np.zeros(len(spaced) + 1, np.int8)
    inside[1:] = _IS_WORD[spaced]
    edge = np.diff(inside)
    start = np.flatnonzero(edge == 1)
    end = np.flatnonzero(edge == -1)
    first = np.zeros(len(ends) + 1, np.int64)
    first[1:] = np.searchsorted(start, at)
    return Words(spaced, start, end, first)


def gram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of each text, and where each text's begin.

    A text of fewer words, but not none, has one shingle of all of them.
    """
    counts = words.counts()
    h = words.hashes()
    grams = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    first = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(grams, out=first[1:])
    if not first[-1]:
        return np.empty(0, np.uint64), first
    head = np.arange(first[-1]) - np.repeat(first[:-1] - words.first[:-1], grams)
    length = np.repeat(np.minimum(counts, n), grams)
    out = np.zeros(len(head), np.uint64)
    for k in range(n):
        use = length > k
        out[use] = mix(out[use] * np.uint64(31) + h[head[use] + k] + np.uint64(k + 1))
    return out, first
