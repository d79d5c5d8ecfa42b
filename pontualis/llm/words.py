"""Words and word runs of whole Arrow string columns, found and hashed with numpy.

Works on UTF-8 bytes: every separator the contracts name is ASCII, so bytes from 0x80 on are
parts of words and a class of code points is a class of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_MULTIPLIER = 0x9E3779B97F4A7C15  # 5 modulo 8, so that anagrams differ in low bits too
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
CHUNK_BYTES = 1 << 20


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


LOWER = _lowered()
_BYTE = np.arange(256)
#: Bytes of words: all but ASCII white space, and ASCII letters, digits and non-ASCII.
NOT_SPACE = ~((_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D)))
ALPHANUMERIC = (((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A))
                | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80))
LETTER = ALPHANUMERIC & ~((_BYTE >= 0x30) & (_BYTE <= 0x39))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[LOWER]
_powers = {_MULTIPLIER: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(1 << (n - 1).bit_length(), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base][:n]


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values and their offsets; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if not len(array):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of values of about ``limit`` bytes each; a longer value is a range of its own."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


@dataclass
class Words:
    doc: np.ndarray  # position of the value that holds the word
    start: np.ndarray
    length: np.ndarray
    hash: np.ndarray  # of the lower-cased (A-Z) bytes


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of ``inside`` bytes; a run ends with its value."""
    n = len(data)
    if not n:
        empty = np.empty(0, np.int64)
        return Words(empty, empty, empty, empty.astype(np.uint64))
    word = inside[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | border[:n]))
    after = np.zeros(n, bool)
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | border[1:]))
    sums = np.cumsum(_VALUE[data] * _power(_MULTIPLIER, n), dtype=np.uint64)
    h = sums[end]
    later = start > 0
    h[later] -= sums[start[later] - 1]
    length = end - start + 1
    h = mix(h * _power(_INVERSE, n)[start] + length.astype(np.uint64))
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(doc, start, length, h)


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``len(h) - k + 1`` runs of ``k`` consecutive words."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        out = out * np.uint64(_MULTIPLIER) + h[i:i + n]
    return mix(out)


def shingles(words: Words, docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all runs of ``k`` words; of a shorter document, the one of all its
    words."""
    h, doc = words.hash, words.doc
    every = runs(h, k)
    own = doc[:len(every)] == doc[k - 1:] if len(every) else np.empty(0, bool)
    counts = np.bincount(doc, minlength=docs)
    first = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < k))
    owners, hashes = [doc[:len(every)][own]], [every[own]]
    for size in range(1, k):
        some = short[counts[short] == size]
        if len(some):
            out = np.full(len(some), np.uint64(size), np.uint64)
            for i in range(size):
                out = out * np.uint64(_MULTIPLIER) + h[first[some] + i]
            owners.append(some)
            hashes.append(mix(out))
    return np.concatenate(owners), np.concatenate(hashes)
