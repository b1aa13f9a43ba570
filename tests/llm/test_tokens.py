"""Segment encoder, counting transducers, packing and records against the tokenizers library and plain Python."""

import zlib
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from leasekit.llm import packing, records, transducer
from leasekit.llm.common import utf8
from leasekit.llm.queries import tokenizer_file
from leasekit.llm.segments import SegmentEncoder
from tests.llm.fixtures import TEXTS, documents, empty

BYTE, WORD = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
PARTS = st.sampled_from(["a", "B", "é", "É", " ", "  ", "\n", "'s", "'", "'re", "'Ll", "'ll", "'v", ".", ",", "!!", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "|", "1", "23", "\t", " ", "́", " ", "ß", "İ", "漢", "Σ", "x=", "the", "̸", "<", ">", "\x00", "…", "œ", " word", " Größe"])
TEXT = st.lists(st.one_of(PARTS, st.text(max_size=2)), max_size=14).map("".join)
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
ENCODERS = {p: SegmentEncoder(p, memo_pieces=500) for p in (BYTE, WORD)}
COUNTER = transducer.TokenCounter(BYTE)


def ids(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_segments_give_the_library_ids(path, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got, sizes = ENCODERS[path].encode(*utf8(pa.array(texts)))
    assert [list(x) for x in np.split(got, np.cumsum(sizes)[:-1])] == [ids(path, t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_transducers_count_the_library_tokens(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert COUNTER.counts(*utf8(pa.array(texts))).tolist() == [len(ids(BYTE, t)) for t in texts]


def test_chunk_maps_compose_to_the_sequential_run():
    classes = np.random.default_rng(1).integers(0, len(transducer.CLASSES), 5000).astype(np.uint8)
    classes[-1] = transducer.CLASSES.index("END")
    whole = transducer.marks(classes, chunk=5000)
    for chunk in (1, 7, 64, 1000):
        assert (transducer.marks(classes, chunk) == whole).all()


def test_token_counts_of_awkward_rows(spark):
    got = transducer.token_counts(documents(spark), BYTE, 1024).collect()
    want = sorted(((i, len((t or "").encode()), len(ids(BYTE, t)), len(ids(BYTE, t)) > 1024) for i, t, _ in TEXTS), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert transducer.token_counts(empty(spark), BYTE, 1024).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.sampled_from([10, 50, 2048]).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 40), max_size=30))))
def test_plan_is_best_fit_decreasing(case):
    capacity, counts = case
    out, opened = packing.plan(counts, capacity)
    table, sequences = sorted(out), defaultdict(list)
    for length, n in counts.items():
        for rank in range(n):
            row = table[bisect_right(table, (length, rank, 1 << 60)) - 1]
            assert row[0] == length
            sequences[row[2] + (rank - row[1]) // row[3]].append((row[4] + (rank - row[1]) % row[3] * length, length))
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            if fit := [g for g in gaps if g >= length]:
                gaps.remove(min(fit))
                gaps.append(min(fit) - length)
            else:
                gaps.append(capacity - length)
    assert len(gaps) == opened == len(sequences)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_of_awkward_rows(spark):
    got = packing.pack(documents(spark), WORD, 64, 0).collect()
    want = []
    for i, t, _ in TEXTS:
        every = np.array([*ids(WORD, t), 0], "<u4")
        want += [(i, k, 64 * k, len(every[64 * k:64 * k + 64]), zlib.crc32(every[64 * k:64 * k + 64].tobytes())) for k in range(-(-len(every) // 64))]
    assert sorted((tuple(r[:5]) for r in got), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        assert sum(n for _, n in parts) <= 64
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
    assert packing.pack(empty(spark), WORD, 64, 0).collect() == []


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (records.POLYNOMIAL if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_frames_have_right_checksums_and_round_trip(kind):
    assert slow_crc32c(b"123456789") == 0xE3069283
    sizes = np.array([1, 2, 3, 255, 256, 257, 700, 1, 5])
    values = np.random.default_rng(2).integers(0, 50_000, sizes.sum()).astype(kind)
    raw, at = records.frame(values, sizes)
    ends = np.cumsum(sizes)
    for a, s, e in zip(at, sizes, ends):
        body = values[e - s:e].tobytes()
        assert int.from_bytes(raw[a:a + 8], "little") == len(body) and raw[a + 12:a + 12 + len(body)] == body
        for data, where in ((raw[a:a + 8], a + 8), (body, a + 12 + len(body))):
            crc = slow_crc32c(data)
            assert int.from_bytes(raw[where:where + 4], "little") == ((crc >> 15 | crc << 17) + records.MASK_DELTA) & 0xFFFFFFFF
    assert (records.unframe(raw, at, sizes, np.dtype(kind)) == values).all()
    spoiled = bytearray(raw)
    spoiled[at[4] + 14] ^= 1
    with pytest.raises(ValueError):
        records.unframe(bytes(spoiled), at, sizes, np.dtype(kind))


def test_records_of_awkward_rows(spark):
    got = sorted(records.token_records(spark, documents(spark), BYTE, 2, files=3).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    want = sorted(((i, len(e), zlib.crc32(e.tobytes())) for i, t, _ in TEXTS for e in [np.array([*ids(BYTE, t), 2], "<u4")]), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == want
    assert records.token_records(spark, empty(spark), BYTE, 2, files=3).collect() == []
