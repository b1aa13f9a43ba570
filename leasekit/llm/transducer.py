"""Operator 4: token counts by compiled finite-state transducers.

A byte-level BPE tokenizer is compiled into a cascade of two deterministic transducers.

*Splitter*: a transducer over 12 character classes with 12 states that marks where pre-tokens begin (the usual
byte-level split pattern with its contractions and whitespace lookahead). A mark may concern the character before the
one just read, because the pattern looks ahead. A text stream is cut into chunks; each chunk's map from entry state to
exit state is computed for all entry states at once, the maps compose by a parallel prefix scan (log2(chunks) steps),
and with the entry states known all chunks are read again at once for their marks.

*Counter*: a transducer over bytes whose transitions carry the change of the token count. Its state is what BPE may
still decide on: the last token of the prefix read, and every way in which a longer vocabulary entry may still cover
the suffix, with the token before that suffix and the count there. Reading a byte, the entry that ends there and forms
a stable pair with the token before it is the new last token (exactly one does: a token sequence is what BPE gives iff
each adjacent pair is), so the count is known without a second look. States are determinised when first reached;
transitions are kept by (state, byte).

The tokens of a text: its special strings, plus the counter's sum over its pre-tokens.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasekit.llm.common import slices, utf8

#: Bounds of a worker's memo and of its counter; beyond them they are compiled afresh.
MEMO_WORDS, MAX_TRANSITIONS = 800_000, 1_500_000
#: Characters in a chunk of the splitter, and those after which most chunks' states have become one.
CHUNK, HEAD = 512, 24

CLASSES = ("LETTER", "STMD", "R", "E", "V", "L", "NUMBER", "SPACE", "WHITE", "QUOTE", "OTHER", "END")
STATES = ("FRESH", "LETTERS", "NUMBERS", "OTHERS", "SPACE1", "WHITE1", "SPACES", "WHITES", "Q", "QR", "QV", "QL")
HERE, BEFORE = 1, 2  # marks: a pre-token begins at this character, at the character before


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """next[class, state] and mark[class, state]."""
    c, s = {n: k for k, n in enumerate(CLASSES)}, {n: k for k, n in enumerate(STATES)}
    letters = ("LETTER", "STMD", "R", "E", "V", "L")
    opens = {**dict.fromkeys(letters, "LETTERS"), "NUMBER": "NUMBERS", "SPACE": "SPACE1", "WHITE": "WHITE1", "QUOTE": "Q", "OTHER": "OTHERS", "END": "FRESH"}
    step, mark = np.zeros((len(CLASSES), len(STATES)), np.uint8), np.zeros((len(CLASSES), len(STATES)), np.uint8)
    for k in CLASSES:
        for state in STATES:
            to, m = opens[k], HERE
            white, other = k in ("SPACE", "WHITE"), k in ("QUOTE", "OTHER")
            if k == "END":  # closes the text; its own mark is taken away again
                m = HERE | BEFORE * (state in ("QR", "QV", "QL"))
            elif state == "LETTERS" and k in letters or state == "NUMBERS" and k == "NUMBER" or state == "OTHERS" and other:
                to, m = state, 0
            elif state in ("SPACE1", "WHITE1", "SPACES", "WHITES") and white:
                to, m = "SPACES" if k == "SPACE" else "WHITES", 0
            elif state in ("SPACE1", "SPACES"):  # the last space goes with what follows
                to, m = "OTHERS" if other else to, BEFORE * (state == "SPACES")
            elif state == "WHITES":  # the last white character stands alone
                m = HERE | BEFORE
            elif state == "Q" and k == "STMD":
                to, m = "FRESH", 0
            elif state == "Q" and k in ("R", "V", "L"):
                to, m = "Q" + k, 0
            elif state == "Q" and other:
                to, m = "OTHERS", 0
            elif state == "QR" and k == "E" or state == "QV" and k == "E" or state == "QL" and k == "L":
                to, m = "FRESH", 0
            elif state in ("QR", "QV", "QL"):  # no contraction: the letter after the quote began a word
                to, m = ("LETTERS", BEFORE) if k in letters else (to, HERE | BEFORE)
            step[c[k], s[state]], mark[c[k], s[state]] = s[to], m
    return step, mark


@cache
def _class_of() -> np.ndarray:
    """Class of every code point."""
    c = {n: k for k, n in enumerate(CLASSES)}
    out = np.full(0x110000, c["OTHER"], np.uint8)
    for p in range(0x110000):
        kind = unicodedata.category(chr(p))[0]
        if kind in "LN":
            out[p] = c["LETTER"] if kind == "L" else c["NUMBER"]
    # White_Space of Unicode: fixed values.
    out[[*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = c["WHITE"]
    out[0x20], out[ord("'")] = c["SPACE"], c["QUOTE"]
    for letter in "stmd":
        out[ord(letter)] = c["STMD"]
    for letter in "revl":
        out[ord(letter)] = c[letter.upper()]
    return out


def marks(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Where a pre-token begins in a stream of classes that starts FRESH and ends with END."""
    step, mark = _splitter()
    n, states = len(classes), len(STATES)
    rows = -(-n // chunk)
    stream = np.full(rows * chunk, CLASSES.index("END"), np.uint8)
    stream[:n] = classes
    stream = np.ascontiguousarray(stream.reshape(rows, chunk).T)
    flat = step.ravel()
    # The map of each chunk, for all entry states. After some characters nearly all chunks are in one state, whatever
    # they began in; from there one state stands for all, and only the other chunks go on with the whole map.
    maps = np.repeat(np.arange(states, dtype=np.uint8)[:, None], rows, 1)
    for column in stream[:HEAD]:
        maps = flat[column.astype(np.uint16) * states + maps]
    open_ = np.flatnonzero((maps != maps[0]).any(0))
    one, rest = maps[0], maps[:, open_]
    for column in stream[HEAD:]:
        base = column.astype(np.uint16) * states
        one = flat[base + one]
        if len(open_):
            rest = flat[base[open_] + rest]
    maps = np.repeat(one[None], states, 0)
    maps[:, open_] = rest
    # Inclusive prefix scan by composition.
    distance = 1
    while distance < rows:
        later = np.take_along_axis(maps[:, distance:], maps[:, :-distance].astype(np.intp), 0)
        maps[:, distance:] = later
        distance *= 2
    state = np.concatenate([[0], maps[0, :-1]]).astype(np.uint8)
    flags, emit = np.empty_like(stream), mark.ravel()
    for k, column in enumerate(stream):
        at = column.astype(np.uint16) * states + state
        flags[k], state = emit[at], flat[at]
    flags = flags.T.ravel()[:n]
    begin = (flags & HERE) != 0
    begin[:-1] |= (flags[1:] & BEFORE) != 0
    return begin


class Counter:
    """The counting transducer of one vocabulary; see the module's text."""

    def __init__(self, spec: dict):
        char_byte = {c: b for b, c in _byte_chars().items()}
        to_bytes = lambda token: bytes(char_byte[c] for c in token)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(to_bytes(a), to_bytes(b)): k for k, (a, b) in enumerate(merges)}
        self.made = {a + b: (k, (a, b)) for (a, b), k in reversed(self.rank.items())}  # by its first merge
        self.whole: dict[bytes, bool] = {}
        self.root: dict = {}
        for token in spec["model"]["vocab"]:
            node = self.root
            for b in to_bytes(token):
                node = node.setdefault(b, {})
            node[-1] = to_bytes(token)
        self.stable: dict[tuple[bytes, bytes], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.state: list[tuple[bytes, tuple]] = []
        self.delta: dict[int, int] = {}  # state * 256 + byte -> next state * 4096 + change + 2048
        self.seen: dict[bytes, int] = {}
        self._number(b"", ())

    def _number(self, last: bytes, open_: tuple) -> int:
        key = (last, tuple((id(node), before, diff) for node, before, diff in open_))
        if key not in self.number:
            self.number[key] = len(self.state)
            self.state.append((last, open_))
        return self.number[key]

    def _bpe(self, word: bytes) -> list[bytes]:
        parts = [word[k:k + 1] for k in range(len(word))]
        while len(parts) > 1:
            best = min((self.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(parts, parts[1:])))
            if best[0] == 1 << 60:
                break
            pair = (parts[best[1]], parts[best[1] + 1])
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def _whole(self, token: bytes) -> bool:
        """Does BPE make one token of these bytes?"""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self._bpe(token) == [token]
        return known

    def _pair(self, before: bytes, token: bytes) -> bool:
        """Does BPE leave these two tokens as they are? (Nothing before: does it leave the one?)

        The merges that made them are undone from the last to the first, on whichever side is later (on the right if
        both are the same merge, for BPE merges from the left); two parts that meet at the border must not have a merge
        that comes before the one just undone.
        """
        if not self._whole(token):
            return False
        if not before:
            return True
        known = self.stable.get((before, token))
        if known is not None:
            return known
        if len(self.stable) > MAX_TRANSITIONS:
            self.stable.clear()
        left, right, undone, known = before, token, 1 << 60, True
        while True:
            if self.rank.get((left, right), 1 << 60) < undone:
                known = False
                break
            of_left, of_right = self.made.get(left), self.made.get(right)
            if of_left is None and of_right is None:
                break
            if of_right is None or of_left is not None and of_left[0] > of_right[0]:
                undone, left = of_left[0], of_left[1][1]
            else:
                undone, right = of_right[0] + 1, of_right[1][0]
        self.stable[before, token] = known
        return known

    def _compile(self, state: int, byte: int) -> int:
        last, open_ = self.state[state]
        grown, end = [], None
        for node, before, diff in (*open_, (self.root, last, 0)):
            if (child := node.get(byte)) is not None:
                grown.append((child, before, diff))
                if end is None and -1 in child and self._pair(before, child[-1]):
                    end = child[-1], diff + 1
        token, change = end
        following = tuple((node, before, diff - change) for node, before, diff in grown if len(node) > (-1 in node))
        out = self.delta[state * 256 + byte] = self._number(token, following) * 4096 + change + 2048
        return out

    def count(self, word: bytes) -> int:
        """Tokens of a pre-token."""
        known = self.seen.get(word)
        if known is None:
            if len(self.seen) > MEMO_WORDS or len(self.delta) > MAX_TRANSITIONS:
                self.reset()
            state = known = 0
            get = self.delta.get
            for byte in word:
                if (found := get(state * 256 + byte)) is None:
                    found = self._compile(state, byte)
                state = found >> 12
                known += (found & 4095) - 2048
            self.seen[word] = known
        return known


def _byte_chars() -> dict[int, str]:
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}


class TokenCounter:
    """Both transducers of a tokenizer file, and its special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.counter = Counter(spec)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special_bytes = [s.encode() for s in special]

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text in a batch of UTF-8 texts."""
        n = len(offsets) - 1
        total = np.zeros(n, np.int64)
        raw = data.tobytes()
        owner = np.arange(n)
        ends = offsets[1:]
        begins = offsets[:-1]
        if any(s in raw for s in self.special_bytes):
            begins, ends, owner = [], [], []
            for k in range(n):
                at = int(offsets[k])
                text = raw[at:offsets[k + 1]]
                for m in re.finditer(self.special.pattern.encode(), text):
                    begins.append(at), ends.append(int(offsets[k]) + m.start()), owner.append(k)
                    at = int(offsets[k]) + m.end()
                    total[k] += 1
                begins.append(at), ends.append(int(offsets[k + 1])), owner.append(k)
            begins, ends, owner = np.array(begins), np.array(ends), np.array(owner)
            raw = b"".join(raw[b:e] for b, e in zip(begins, ends))
            sizes = ends - begins
            ends = np.cumsum(sizes)
            begins = ends - sizes
        if not raw:
            return total
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80) + (points >= 0x800).astype(np.int8) + (points >= 0x10000)
        at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(width, out=at[1:])
        # One END after each text.
        stop = np.searchsorted(at, ends)
        classes = np.insert(_class_of()[points], stop, CLASSES.index("END"))
        begin = marks(classes)
        begin[stop + np.arange(len(stop))] = False
        begin = np.flatnonzero(np.delete(begin, stop + np.arange(len(stop))))
        words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(at[begin], len(raw))), pa.py_buffer(raw)]).dictionary_encode()
        count = self.counter.count
        known = np.fromiter(map(count, words.dictionary.to_pylist()), np.int64, len(words.dictionary))
        each = np.concatenate([[0], np.cumsum(known[words.indices.to_numpy(zero_copy_only=False)])])
        first = np.searchsorted(at[begin], begins)
        last = np.searchsorted(at[begin], ends)
        np.add.at(total, owner, each[last] - each[first])
        return total


_COUNTERS: dict[str, TokenCounter] = {}


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` (n_tokens > limit) of every whole text.

    Null or empty text: 0 bytes and 0 tokens. Rows are kept one to one (repeated rows and null doc_ids too); an empty
    table gives an empty result; further columns are not read. No shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _COUNTERS:
            _COUNTERS[tokenizer_path] = TokenCounter(tokenizer_path)
        counter = _COUNTERS[tokenizer_path]
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(counter.counts(data, offsets))], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
