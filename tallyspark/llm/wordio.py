"""Arrow/numpy word splitting shared by the Python-side operators (runs inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about this many characters, so memory stays bounded
#: by one slice (or by the longest single text): word codes, hashes and their temporaries take
#: some twenty times a slice.
SLICE_CHARS = 3_000_000


def text_slices(texts: pa.Array, limit: int = SLICE_CHARS):
    """Consecutive ``(start, stop)`` ranges of at most ``limit`` bytes (one text at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if len(sizes) > start:
        yield start, len(sizes)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (ASCII white space separates them; null: none) of every text.

    Returns ``(counts, codes, vocabulary)``: words per text, the words of all texts in
    order as positions in ``vocabulary``, and the distinct words as an object array.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    counts = np.asarray(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    vocabulary = coded.dictionary.to_numpy(zero_copy_only=False)
    empty = np.flatnonzero(vocabulary == "")
    if len(empty):  # leading and trailing white space yields empty words
        real = codes != empty[0]
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts))
        codes = codes[real]
    return counts, codes, vocabulary


def word_hashes(vocabulary: np.ndarray) -> np.ndarray:
    """64-bit content hashes of words (the same in every process)."""
    from pandas.util import hash_array

    return hash_array(vocabulary.astype(object), categorize=False) if len(vocabulary) else np.empty(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
