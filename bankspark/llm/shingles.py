"""Word shingles of whole texts as sets of 64-bit hashes, computed for many documents at once in numpy.

Words are the runs of bytes other than blank and tab to carriage return, after lower-casing A to Z.  A
document's set holds its distinct shingles of ``n`` words; with fewer words the whole sequence is one
shingle (apart from all n-word shingles); without words the set is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from bankspark.llm.arrow_text import text_bytes
from bankspark.llm.words import mix, span_hashes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = mix(_LOWER.astype(np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACES = mix(np.arange(1000, 1064)) | np.uint64(1)


def byte_values(data: np.ndarray) -> np.ndarray:
    """Scrambled value of each byte, upper and lower case alike."""
    return _VALUES[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each document and in all) of the words; no word crosses documents."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes_of(column: pa.Array, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, words before each text and in all)."""
    data, offsets = text_bytes(column)
    data = data[offsets[0]:offsets[-1]]
    starts, ends, first = word_spans(data, offsets - offsets[0], separator)
    return mix(span_hashes(_VALUES[data], starts, ends)), first


def sequence_hash(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    out = np.full(len(first), np.uint64(n))
    for k in range(n):
        out += words[first + k] * _PLACES[k % 64]
        out ^= out >> np.uint64(31)
    return mix(out)


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, first = word_hashes_of(column)
    counts = np.diff(first)
    if len(words) >= n:
        grams = sequence_hash(words, np.arange(len(words) - n + 1), n)
    out = []
    for at, m in zip(first[:-1].tolist(), counts.tolist()):
        if m >= n:
            out.append(np.unique(grams[at:at + m - n + 1]))
        elif m:
            out.append(sequence_hash(words, np.array([at]), m))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
