"""Words of whole texts as 64-bit hashes, computed over blocks of bytes with NumPy.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D after lower-casing
A-Z; no byte of a longer UTF-8 character falls in either class, so bytes and
characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

U64 = np.uint64
_M1, _M2, _M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: bytes of text handled at a time; a longer text is a block of its own
BLOCK_BYTES = 4 << 20
#: words longer than this are hashed one by one
_LONG_WORD = 512


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * _M2
    x = x ^ (x >> U64(27))
    x = x * _M3
    return x ^ (x >> U64(31))


def blocks(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Index ranges of about BLOCK_BYTES of text each."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text) + 1 if text else 1
        if held >= BLOCK_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def word_spans(texts: list[bytes | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts lower-cased in one piece of bytes, begin and end of every word in it, and the first
    word of each text (one more entry at the end)."""
    blob = b"\n".join(t or b"" for t in texts) + b"\n" * 9
    low = blob.lower()
    blank = _BLANK[np.frombuffer(low, dtype=np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edges = np.concatenate([[0], edges])
    begin, end = edges[0::2], edges[1::2]
    lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    first = np.searchsorted(begin, offsets)
    first[-1] = len(begin)
    return low, begin, end, first


def hash_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the first word of each text (one more entry at the end)."""
    low, begin, end, first = word_spans(texts)
    return hash_spans(low, begin, end), first


def hash_spans(low: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every span."""
    size = end - begin
    eight = np.ndarray((len(low) - 7,), dtype="<u8", buffer=low, strides=(1,))
    h = size.astype(U64) * _M1
    h = mix(h ^ (eight[begin] & _KEEP[np.minimum(size, 8)]))
    active, k = np.flatnonzero(size > 8), 8
    while len(active):
        if k > _LONG_WORD:
            for i in active.tolist():
                h[i] = xxhash.xxh3_64_intdigest(low[begin[i]:end[i]])
            break
        part = eight[begin[active] + k] & _KEEP[np.minimum(size[active] - k, 8)]
        h[active] = mix((h[active] + _M1) ^ part)
        k += 8
        active = active[size[active] > k]
    return h


def shingle_arrays(texts: list[bytes | None], n: int) -> Iterator[np.ndarray]:
    """Per text the hashes of its n-word shingles, in order, with repeats.

    A text of fewer words, but not none, has its whole sequence as one shingle.
    """
    for lo, hi in blocks(texts):
        h, first = hash_words(texts[lo:hi])
        rolled = np.zeros(max(len(h) - n + 1, 0), dtype=U64)
        for k in range(n):
            rolled = mix(rolled + h[k:k + len(rolled)] * U64(2 * k + 3))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= n:
                yield rolled[a:b - n + 1]
            elif b > a:
                whole = np.full(1, b - a, dtype=U64)
                for x in h[a:b]:
                    whole = mix(whole * _M1 + x)
                yield whole
            else:
                yield h[:0]
