"""Words of whole texts as 64-bit codes, for a batch of texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, word number of each word, text offsets): the runs of
    anything but ASCII white space (space, tab to carriage return)."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    index = coded.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:  # from white space at an end, or an empty text
        full = index != empty
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets - offsets[0]]
        index = index[full]
        index = index - (index > empty)
    distinct = coded.dictionary if empty < 0 else coded.dictionary.filter(pc.not_equal(coded.dictionary, ""))
    return distinct, index, offsets - offsets[0]


def code(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def codes(distinct: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))


def lower(texts: pa.Array) -> pa.Array:
    """A-Z to a-z, nothing else."""
    return pc.ascii_lower(texts)


def spread(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that nearby ones fall far apart."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(word_codes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes of runs of ``width`` words, text offsets); a text of fewer words
    has one run of all its words, a text without words none."""
    counts = np.diff(offsets)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate([[0], np.cumsum(n)])
    starts = np.repeat(offsets[:-1] - out_offsets[:-1], n) + np.arange(out_offsets[-1])
    ends = np.repeat(offsets[1:], n)
    total = np.zeros(len(starts), np.uint64)
    for k in range(width):
        at = starts + k
        inside = at < ends
        word = word_codes[np.where(inside, at, 0)] if len(word_codes) else np.zeros(len(at), np.uint64)
        total = np.where(inside, spread(total * MIX + word + np.uint64(k + 1)), total)
    return total, out_offsets
