"""Sets of word shingles as sorted 64-bit numbers, a column at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from obsmart.llm.common import texts

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, from the golden ratio


def spread(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit numbers: the finalizer of MurmurHash3 (fixed constants)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, set sizes): each text's distinct shingles of ``n`` words,
    ascending, text after text. Capitals A-Z count as small letters; a text of
    fewer words is one shingle, without words none. A number stands for its words
    in order, up to a collision of 64-bit hashes."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts(column)))
    bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
    word = coded.indices.to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(column)), np.diff(bounds))
    if "" in (real := dict.fromkeys(names)):
        keep = word != list(real).index("")
        word, doc = word[keep], doc[keep]
    found = hashes[word]
    counts = np.bincount(doc, minlength=len(column))
    begin = np.cumsum(counts) - counts
    whole = np.zeros(max(0, len(found) - n + 1), np.uint64)
    for k in range(n):
        whole = whole * _STEP + found[k : k + len(whole)]
    inside = doc[: len(whole)] == doc[n - 1 :] if len(whole) else np.zeros(0, bool)
    owner, value = doc[: len(whole)][inside], spread(whole[inside] ^ np.uint64(n))
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            h = np.zeros(len(short), np.uint64)
            for k in range(size):
                h = h * _STEP + found[begin[short] + k]
            owner, value = np.concatenate([owner, short]), np.concatenate([value, spread(h ^ np.uint64(size))])
    if (np.diff(owner) < 0).any():
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], value[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(column)))
    at = 0
    for end in ends.tolist():
        value[at:end].sort()
        at = end
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[first], np.bincount(owner[first], minlength=len(column))


def digests(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """16 bytes for each set (two sums of mixed numbers), as an array of uint64 pairs."""
    out = np.zeros((len(sizes), 2), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        out[some, 0] = np.add.reduceat(spread(numbers ^ np.uint64(0xA5A5A5A5)), starts)
        out[some, 1] = np.add.reduceat(spread(numbers + _STEP), starts)
    return out
