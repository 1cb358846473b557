"""Words of whole texts as arrays of 64-bit hashes; windows of words as hashes of those."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Odd multipliers for wrapping 64-bit arithmetic.
_MIX_1, _MIX_2, _MIX_3 = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0xD1342543DE82EF95


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words (runs of bytes other than space and tab to carriage return), and where each text's begin.

    `offsets` has one more entry than there are texts. A null text has no words. `lower` changes A-Z only.
    """
    texts = pc.fill_null(texts, "")
    if texts.offset:  # a cast of a sliced array can go wrong
        texts = texts.take(pa.array(range(len(texts))))
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    empty = np.asarray(pc.equal(pc.binary_length(flat), 0))
    if empty.any():  # a text without words splits into one empty string
        before = np.concatenate(([0], np.cumsum(~empty)))
        flat, offsets = flat.filter(pa.array(~empty)), before[offsets]
    return flat, offsets


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; equal words are hashed once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    own = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()),
        np.uint64, len(coded.dictionary),
    )
    return own[np.asarray(coded.indices)]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    with np.errstate(over="ignore"):
        v = values + _MIX_1
        v = (v ^ (v >> np.uint64(30))) * _MIX_2
        v = (v ^ (v >> np.uint64(27))) * _MIX_3
        return v ^ (v >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """The hash of each run of `size` words, by where it starts; runs may cross texts.

    A polynomial in an odd base modulo 2^64, by sums of prefixes: the cost doesn't grow with `size`.
    """
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        if size <= 8:
            total = hashes[:count].copy()
            for k in range(1, size):
                total *= np.uint64(base)
                total += hashes[k:k + count]
            return mix(total)
        n = len(hashes)
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        inverse = np.full(count, pow(base, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers, out=sums[1:])
        return mix((sums[size:] - sums[:-size]) * inverse)
