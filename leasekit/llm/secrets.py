"""Operator 7: secret scan by patterns and by token efficiency.

Three base kinds are found by fixed patterns. The method adds a fourth, ``random``: a run of at least ``MIN_RUN`` key
characters that a tiktoken vocabulary needs many tokens for (under ``MAX_RATIO`` characters a token) is a random string,
since ordinary words, numbers and names merge into longer tokens. Not counted: known digests (hexadecimal of the usual
digest lengths, UUIDs), identifiers (runs with under half of ``MIN_RUN`` characters in parts between separators that are themselves inefficient
under the vocabulary; a part of one token is efficient), runs of few different characters, and what a base span covers.
A run with words beside a key, as a path or a dotted name, is efficient as a whole; there the ratio is taken of each longest
stretch of inefficient parts (parts of up to three characters may lie between), and the span is that stretch.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasekit.llm.common import slices, utf8

KINDS = ("assign", "access", "hex", "random")
#: Patterns and least lengths of the base kinds: fixed values.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs are the matches of [0-9a-f]+, so only long ones are looked for
MIN_ASSIGN, MIN_ACCESS = 6, 20
_HINTS = ("passw", "secret", "token", "api")

MIN_RUN, MAX_RATIO = 20, 2.0
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
#: Runs in which stretches are looked for: dots belong to them.
DOTTED = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % MIN_RUN)
_PART = re.compile(r"[A-Za-z0-9]+")
_RUN_BYTES = bytes(int(chr(b).isalnum() and b < 128 or chr(b) in "+/_=.-") for b in range(256))
#: Hexadecimal lengths of usual digests: fixed values.
DIGESTS = (32, 40, 56, 64, 96, 128)
_HEX_ONLY = re.compile(r"[0-9a-fA-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_SEPARATORS = re.compile(r"[+/_=-]+")
SPANS = "array<struct<kind:string,start:int,end:int>>"


def _tokens(path: str):
    """A function that counts tiktoken tokens of ASCII runs with the ranks in ``path``."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("ranks", pat_str=r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]+", mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(coder.encode_ordinary(text))


def _known(run: str) -> bool:
    return bool(_HEX_ONLY.fullmatch(run) and len(run) in DIGESTS or _UUID.fullmatch(run)) or len(set(run)) < 8


def stretches(run: str, tokens) -> list[tuple[int, int]]:
    """Start and end of the random stretches of a run: consecutive inefficient parts, MIN_RUN characters at least."""
    found, begin, end = [], -1, -1
    uuids = [m.span() for m in _UUID.finditer(run)]

    def close() -> None:
        if begin >= 0 and end - begin >= MIN_RUN and not _known(run[begin:end]) and end - begin < MAX_RATIO * tokens(run[begin:end]):
            found.append((begin, end))

    for m in _PART.finditer(run):
        inside = any(a <= m.start() < b for a, b in uuids)
        n = 0 if inside or _HEX_ONLY.fullmatch(m[0]) and len(m[0]) in DIGESTS else tokens(m[0])
        if n > 1 and len(m[0]) < MAX_RATIO * n:
            begin = m.start() if begin < 0 else begin
            end = m.end()
        elif inside or len(m[0]) > 3:
            close()
            begin = -1
    close()
    return found


def is_random(run: str, tokens) -> bool:
    if _known(run) or len(_UUID.sub("", run)) < MIN_RUN:
        return False
    odd = 0
    for part in _SEPARATORS.split(run):
        if part and (n := tokens(part)) > 1 and len(part) < MAX_RATIO * n:
            odd += len(part)
    if odd < MIN_RUN // 2:  # words, numbers and names between separators
        return False
    return len(run) < MAX_RATIO * tokens(run)


def scan(text: str, tokens, long_run: bool = True) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of all spans by start, then kind. ``long_run``: whether the text may have runs of
    ``MIN_RUN`` key characters."""
    spans = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if long_run:
        if "AKIA" in text:
            spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
        spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
        base = sorted(spans)
        covered = lambda a, b: any(s <= a and b <= e for s, e, _ in base)
        for d in DOTTED.finditer(text):
            whole = [m.span() for m in RUN.finditer(text, d.start(), d.end()) if not covered(*m.span()) and is_random(m[0], tokens)]
            parts = [(d.start() + a, d.start() + b) for a, b in stretches(d[0], tokens)]
            parts = [p for p in parts if not covered(*p) and not any(a < p[1] and p[0] < b for a, b in whole)]
            spans += [(a, b, 3) for a, b in whole + parts]
    return sorted(spans, key=lambda x: (x[0], x[2]))


def _long_runs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have a run of MIN_RUN key bytes (or may have: a run may cross into the next text)."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = np.frombuffer(data.tobytes().translate(_RUN_BYTES), np.int8)
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    long = ends - starts >= MIN_RUN
    out = np.zeros(len(offsets) - 1, bool)
    first = np.searchsorted(offsets, starts[long], "right") - 1
    last = np.searchsorted(offsets, ends[long] - 1, "right") - 1
    for a, b in zip(first, last):
        out[a:b + 1] = True
    return out


_COUNTERS: dict = {}


def _tokens_of(path: str):
    """One counter for each vocabulary file and worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = _tokens(path)
    return _COUNTERS[path]


def with_spans(docs: DataFrame, tiktoken_path: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``secret_spans`` (kind, start, end in code points, by start then kind) of every
    whole text. Null or empty text: no spans. Rows stay one to one. No shuffle."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens_of(tiktoken_path)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches, "secret_text"):
            data, offsets = utf8(batch.column("secret_text"))
            raw, long = data.tobytes(), _long_runs(data, offsets)
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in scan(raw[a:b].decode(), tokens, r)] for a, b, r in zip(offsets[:-1], offsets[1:], long)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(spans, kind)], names=[*keep, "secret_spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col("text").alias("secret_text")).mapInArrow(find, f"{fields}, secret_spans {SPANS}")


def scan_secrets(docs: DataFrame, tiktoken_path: str) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` of every document.

    ``spans`` lists all spans as kind:start:end by start, then kind, joined by commas (none: empty string);
    ``base_sha256`` is the SHA-256 of the list of base spans. Empty tables give empty results; further columns are not read.
    """
    found = with_spans(docs, tiktoken_path, ["doc_id"])
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secret_spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *map(count, KINDS), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("secret_spans")).alias("spans"))


def redact(docs: DataFrame, tiktoken_path: str, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; n_chars follows the new text. Rows and
    columns stay as they are else; texts without spans are untouched, null stays null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens_of(tiktoken_path)
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            raw, long = data.tobytes(), _long_runs(data, offsets)
            texts, sizes = {}, {}
            for k, (a, b, r) in enumerate(zip(offsets[:-1], offsets[1:], long)):
                text = raw[a:b].decode()
                if spans := scan(text, tokens, r):
                    out, at = [], 0
                    for start, end, _ in spans:
                        if start >= at:
                            out += [text[at:start], mark]
                        at = max(at, end)
                    texts[k] = "".join([*out, text[at:]])
                    sizes[k] = len(texts[k])
            if texts:
                for name, new in (("text", texts), ("n_chars", sizes)):
                    if name in batch.schema.names:
                        column = batch.column(name).to_pylist()
                        for k, value in new.items():
                            column[k] = value
                        at = batch.schema.get_field_index(name)
                        batch = batch.set_column(at, batch.schema.field(at), pa.array(column, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(cut, docs.schema)
