"""Words of many texts as numpy codes, for operators over word windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from leasekit.llm.common import runs


def split_words(data: np.ndarray, offsets: np.ndarray, word_bytes: bytes) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words (runs of bytes whose entry in the 256-byte table ``word_bytes`` is 1) of a batch of texts.

    Returns all words, dictionary-encoded, the number of words of each text, and the words' byte starts.
    """
    n = len(data)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = np.frombuffer(data.tobytes().translate(word_bytes), np.int8)
    change = np.diff(inside)
    starts, ends = change[:-1] == 1, change[1:] == -1
    border = offsets[1:-1]
    border = border[(border > 0) & (border < n)]
    if n and len(border):  # a word does not go on in the next text
        both = border[(inside[border] == 1) & (inside[border + 1] == 1)]
        starts[both] = True
        ends[both - 1] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    kept = data[inside[1:-1] == 1]
    word_offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(word_offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept))])
    return words.dictionary_encode(), np.diff(np.searchsorted(starts, offsets)), starts


def windows(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of every window of ``size`` words inside one text."""
    each = np.maximum(counts - size + 1, 0)
    first = np.cumsum(counts) - counts
    return np.repeat(first, each) + runs(each), np.repeat(np.arange(len(counts)), each)
