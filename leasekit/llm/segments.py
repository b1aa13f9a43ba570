"""Exact token ids at memo speed: a text is cut where the tokenizer itself must cut, and each different piece is
encoded by the ``tokenizers`` library once per worker.

A cut is made only where, whatever stands further away, every tokenizer used here (byte-level BPE with the usual
split pattern; lower-casing word BPE) begins a new pre-token:

* before one space or newline between two visible characters, and after such a newline;
* before ASCII punctuation that follows a letter. Apostrophes (contractions) and ``< | >`` (special strings) never cut.

"Visible" is printable ASCII or a two-byte letter U+00C0-U+017F; other characters are never cut at, so combining
marks and Unicode spaces stay inside a piece and are left to the library.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Different pieces kept by a worker; beyond it the memo starts afresh (memory stays bounded, results do not change).
MEMO_PIECES = 400_000
_SIZE_BITS = 28

_VISIBLE, _LEAD, _LETTER, _PUNCTUATION, _SPACE, _NEWLINE = 1, 2, 4, 8, 16, 32
_KINDS = bytes(
    _VISIBLE * (0x21 <= b < 0x7F) | _LEAD * (b in (0xC3, 0xC4, 0xC5)) | _LETTER * bytes([b]).isalpha()
    | _PUNCTUATION * (0x21 <= b < 0x7F and not chr(b).isalnum() and chr(b) not in "'<|>")
    | _SPACE * (b in (10, 32)) | _NEWLINE * (b == 10)
    for b in range(256)
)
_WORD = re.compile(r" ?([A-Za-zÀ-ÖØ-öø-ÿ]+)")


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all pieces in ``data`` (plus its end), and how many pieces each text has."""
    n = len(data)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    kind = np.frombuffer(data.tobytes().translate(_KINDS), np.uint8)
    start = np.zeros(n + 1, bool)
    if n > 2:
        seen_last = kind[:-2] & _VISIBLE
        seen_last[1:] |= (kind[:-3] & _LEAD) >> 1
        lone = (kind[1:-1] & _SPACE != 0) & (seen_last != 0) & (kind[2:] & (_VISIBLE | _LEAD) != 0)
        start[1:n - 1] = lone
        start[2:n] |= lone & (kind[1:-1] & _NEWLINE != 0)
    start[1:n] |= (kind[1:] & _PUNCTUATION != 0) & (kind[:-1] & _LETTER != 0)
    start[offsets] = True
    start[n] = False
    at = np.flatnonzero(start)
    first = np.searchsorted(at, offsets)
    return np.append(at, n), np.diff(first)


class SegmentEncoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo_pieces = memo_pieces
        self.lower = self.tokenizer.normalizer is not None  # the word BPE lower-cases; the byte BPE has no normalizer
        self.model = self.tokenizer.model
        self.byte_char = self._byte_chars()
        self._clear()

    @staticmethod
    def _byte_chars() -> dict[int, str]:
        """The printable character that byte-level BPE writes for each byte: its own one if printable, else 256 + k."""
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in own]
        return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def _clear(self) -> None:
        self.memo: dict[bytes, int] = {}  # piece -> place of its ids in the pool, and their number
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _encode(self, piece: bytes) -> list[int]:
        """The library's ids of a piece. A run of letters is one pre-token, so the library's model decides alone."""
        word = piece[1:] if piece[:1] == b" " else piece
        if word.isalpha():  # ASCII letters
            text = word.lower().decode() if self.lower else word.decode() if word is piece else "Ġ" + word.decode()
        elif match := _WORD.fullmatch(text := piece.decode()):
            text = (match[1].lower() if self.lower else text).encode().decode("latin-1").translate(self.byte_char)
        else:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize(text)]

    def _add(self, piece: bytes) -> int:
        ids = self._encode(piece)
        end = self.used + len(ids)
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool) // 2, len(ids)), np.int32)])
        self.pool[self.used:end] = ids
        place = self.memo[piece] = self.used << _SIZE_BITS | len(ids)
        self.used = end
        return place

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another as int32, number of ids of each text)."""
        if len(self.memo) > self.memo_pieces:
            self._clear()
        at, counts = cut(data, offsets)
        if len(at) == 1:
            return np.zeros(0, np.int32), counts
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        get, add = self.memo.get, self._add
        known = np.fromiter((k if (k := get(p)) is not None else add(p) for p in pieces.dictionary.to_pylist()), np.int64, len(pieces.dictionary))
        which = known[pieces.indices.to_numpy(zero_copy_only=False)]
        begin, size = which >> _SIZE_BITS, which & ((1 << _SIZE_BITS) - 1)
        ends = np.cumsum(size)
        ids = self.pool[np.repeat(begin - (ends - size), size) + np.arange(ends[-1])]
        text_ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(text_ends)


_ENCODERS: dict[str, SegmentEncoder] = {}


def encoder(path: str) -> SegmentEncoder:
    """One encoder for each vocabulary file and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = SegmentEncoder(path)
    return _ENCODERS[path]
