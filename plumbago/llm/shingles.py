"""Word hashes and word n-gram hashes of whole texts, many texts at a time.

A word is what white space delimits, in lower case. The hash of an n-gram mixes the hashes of its words in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MIX1, _MIX2, _BASE = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit."""
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


#: A random number for each byte, and the powers that tell a byte's place in its word.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_POWERS = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(255, _BASE))])
#: Bytes of words that are hashed at once.
HASHED = 1 << 20


def string_hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of large_strings without nulls: the sum, modulo 2**64, of each byte's number times its place's power."""
    global _POWERS
    if not len(strings):
        return np.empty(0, np.uint64)
    buffers = strings.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
    sizes = np.diff(offsets)
    longest = int(sizes.max())
    if longest > len(_POWERS):
        _POWERS = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(longest - 1, _BASE))])
    found = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    first = 0
    while first < len(full):
        last = max(first + 1, int(np.searchsorted(offsets[full], offsets[full[first]] + HASHED)))
        some = full[first:last]
        begins = np.cumsum(sizes[some]) - sizes[some]
        part = data[offsets[some[0]] : offsets[some[-1] + 1]]
        value = _BYTE[part] * _POWERS[np.arange(len(part)) - np.repeat(begins, sizes[some])]
        found[some] = mixed(np.add.reduceat(value, begins) + sizes[some].astype(np.uint64))
        first = last
    return found


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and the n + 1 offsets of the texts; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    # Trimmed first: at white space that ends its buffer, the split would read on behind it.
    words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))))
    flat = words.flatten()
    found = string_hashes(flat)
    offsets = np.asarray(words.offsets).astype(np.int64)
    offsets -= offsets[0] if len(offsets) else 0
    real = np.asarray(pc.binary_length(flat)) > 0  # a text without words has one empty word
    if not real.all():
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        found = found[real]
    return found, offsets


def gram_hashes(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams, and the texts' offsets. A text of 1 to n - 1 words has one n-gram: all its words."""
    sizes = np.diff(offsets)
    counts = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    ends = np.cumsum(counts)
    begins = np.concatenate([[0], ends])
    at = np.arange(begins[-1]) + np.repeat(offsets[:-1] - begins[:-1], counts)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    short = np.repeat(np.minimum(sizes, n), counts)
    found = np.zeros(len(at), np.uint64)
    for k in range(n):
        word = padded[at + k]
        if k:
            word = np.where(short > k, word, np.uint64(0))
        found = mixed(found * _BASE + word + np.uint64(k + 1))
    return found, begins
