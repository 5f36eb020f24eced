"""Word shingles of many texts at once, as 64-bit fingerprints."""

from __future__ import annotations

import numpy as np

from tickframe.llm.common import SpanHash, mix

# Multipliers for the words of a shingle, derived from their place.
_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of every maximal run of bytes other than space and 0x09-0x0D; texts do not touch."""
    word = (data != 32) & ((data < 9) | (data > 13))
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    borders = off[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    begins[borders] = word[borders]
    ends[borders - 1] = word[borders - 1]
    start = np.flatnonzero(begins)
    return np.searchsorted(off, start, "right") - 1, start, np.flatnonzero(ends) + 1


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, end to end, and the n + 1 offsets.

    Words are lower-cased (A to Z). A text of fewer than k words has its whole sequence as one shingle, a text
    without words has none.
    """
    n = len(off) - 1
    data = lower_ascii(data)
    text, start, end = word_spans(data, off)
    words = SpanHash(data).spans(start, end)
    count = np.bincount(text, minlength=n)
    first = np.cumsum(count) - count
    left = count[text] - (np.arange(len(text)) - first[text])
    size = np.minimum(count, k)[text]
    use = np.flatnonzero(left >= size)  # a short text's first word only
    h = np.zeros(len(use), np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    short = size[use] < k
    for j in range(k):
        part = padded[use + j] * _PLACE[j]
        if short.any():
            part[size[use] <= j] = 0
        h += part
    h = mix(h + size[use].astype(np.uint64) * _PLACE[63])
    text = text[use]
    bounds = np.searchsorted(text, np.arange(n + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], np.searchsorted(text[new], np.arange(n + 1))


def parity_maps(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """256 parity bits of every set (as four signed 64-bit numbers): each element flips one bit.

    Two maps differ in at most as many bits as the sets differ in elements.
    """
    n = len(at) - 1
    place = (h >> np.uint64(7)) % np.uint64(256)
    key = np.repeat(np.arange(n), np.diff(at)) * 4 + (place >> np.uint64(6)).astype(np.int64)
    out = np.zeros(4 * n, np.uint64)
    np.bitwise_xor.at(out, key, np.uint64(1) << (place & np.uint64(63)))
    return out.reshape(n, 4).view(np.int64)
