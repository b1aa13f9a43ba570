"""Operator 9: token ids in length-delimited binary records with masked checksums and a separate offset index.

File format (one file per range of ids, little endian), the framing of public TFRecord files:

    uint64 payload length | uint32 masked CRC-32C of those 8 bytes | payload | uint32 masked CRC-32C of the payload

``mask(c) = rotate_right(c, 15) + 0xA282EAD8``. The payload holds the document's ids as uint16 if the vocabulary
fits, else as uint32. The index is a Parquet table ``file, record, at (byte offset), n_tokens, start_in_file,
doc_id``, so a reader can fetch records in any order.

A task writes under a name of its own attempt, and only files named in the committed index count: retried or
speculative tasks leave no wrong data.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leasekit.llm.common import runs, scratch, slices, utf8
from leasekit.llm.segments import encoder

#: CRC-32C polynomial (reflected) and the mask constant of the record format: fixed values.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
#: Words of 16 bits that one lane of the checksum handles.
LANE = 256
INDEX = "file string, record int, at long, n_tokens long, start_in_file long, doc_id long, width int"
_INDEX_ARROW = pa.schema([("file", pa.string()), ("record", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("start_in_file", pa.int64()), ("doc_id", pa.int64()), ("width", pa.int32())])
_RESULT_ARROW = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


@cache
def _word_table() -> np.ndarray:
    """CRC-32C of all 16-bit words."""
    crc = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(POLYNOMIAL), crc >> 1)
    return crc


@cache
def _lane_shift() -> np.ndarray:
    """What LANE zero words make of a register, by its four bytes."""
    table, out = _word_table(), np.zeros((4, 256), np.uint32)
    for k in range(4):
        reg = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(LANE):
            reg = table[reg & 0xFFFF] ^ (reg >> np.uint32(16))
        out[k] = reg
    return out


def crc32c(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32C of each run of 16-bit ``words``; ``sizes``: words of each run, at least 2.

    The first four bytes take the initial register; leading zero words then change nothing, so every run is padded
    in front to whole lanes, all lanes are summed at once, and a run's lanes are joined by the fixed lane shift.
    """
    table, shift = _word_table(), _lane_shift()
    lanes = -(-sizes // LANE)
    ends = np.cumsum(sizes)
    pad = np.zeros(int(lanes.sum()) * LANE, np.uint16)
    lane_ends = np.cumsum(lanes)
    place = np.repeat(lane_ends * LANE - sizes, sizes) + runs(sizes)
    pad[place] = words
    first = lane_ends * LANE - sizes
    pad[first] ^= 0xFFFF
    pad[first + 1] ^= 0xFFFF
    pad = np.ascontiguousarray(pad.reshape(-1, LANE).T)
    reg = np.zeros(pad.shape[1], np.uint32)
    for row in pad:
        reg = table[(reg & 0xFFFF) ^ row] ^ (reg >> np.uint32(16))
    out = np.zeros(len(sizes), np.uint32)
    at = lane_ends - lanes
    for step in range(int(lanes.max(initial=0))):
        some = np.flatnonzero(lanes > step)
        c = out[some]
        out[some] = shift[0][c & 255] ^ shift[1][(c >> 8) & 255] ^ shift[2][(c >> 16) & 255] ^ shift[3][c >> 24] ^ reg[at[some] + step]
    return out ^ np.uint32(0xFFFFFFFF)


def mask(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def frame(ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All records' bytes, and the byte offset of each record. ``ids``: uint16 or uint32; every size at least 1."""
    width = ids.itemsize
    payload = ids.view(np.uint8)
    bytes_each = sizes * width
    head = np.ascontiguousarray(bytes_each.astype("<u8"))
    head_crc = mask(crc32c(head.view(np.uint16), np.full(len(sizes), 4)))
    body_crc = mask(_body_crc(ids, sizes))
    total = bytes_each + 16
    at = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    for k in range(8):
        out[at + k] = head.view(np.uint8)[k::8]
    for k in range(4):
        out[at + 8 + k] = (head_crc >> np.uint32(8 * k)) & 255
        out[at + 12 + bytes_each + k] = (body_crc >> np.uint32(8 * k)) & 255
    inside = np.ones(len(out), bool)
    for begin, size in zip(at, bytes_each):
        inside[begin:begin + 12] = False
        inside[begin + 12 + size:begin + 16 + size] = False
    out[inside] = payload
    return out.tobytes(), at


def _body_crc(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    words, sizes = ids.view(np.uint16), sizes * (ids.itemsize // 2)
    out = np.zeros(len(sizes), np.uint32)
    long = sizes > 1
    if long.any():
        out[long] = crc32c(words[np.repeat(long, sizes)], sizes[long])
    if not long.all():  # a single 16-bit word is shorter than the register
        reg = np.full(int((~long).sum()), 0xFFFFFFFF, np.uint32)
        word = words[(np.cumsum(sizes) - sizes)[~long]]
        out[~long] = (_word_table()[(reg & 0xFFFF) ^ word] ^ (reg >> np.uint32(16))) ^ np.uint32(0xFFFFFFFF)
    return out


def unframe(raw: bytes, at: np.ndarray, sizes: np.ndarray, dtype: np.dtype) -> np.ndarray:
    """Ids of the records at ``at`` in ``raw``; raises if a length or checksum does not fit."""
    data = np.frombuffer(raw, np.uint8)
    bytes_each = sizes * dtype.itemsize
    four = lambda where: sum(data[where + k].astype(np.uint32) << np.uint32(8 * k) for k in range(4))
    head = np.stack([data[at + k] for k in range(8)], 1)
    length = np.ascontiguousarray(head).view("<u8")[:, 0]
    if (length != bytes_each).any() or (four(at + 8) != mask(crc32c(np.ascontiguousarray(head).view(np.uint16).ravel(), np.full(len(at), 4)))).any():
        raise ValueError("a record's length does not fit its checksum or the index")
    payload = data[np.repeat(at + 12, bytes_each) + runs(bytes_each)] if len(at) and bytes_each.sum() < 1 << 16 else np.concatenate([data[a + 12:a + 12 + b] for a, b in zip(at, bytes_each)] or [data[:0]])
    ids = payload.view(dtype)
    if (four(at + 12 + bytes_each) != mask(_body_crc(ids, sizes))).any():
        raise ValueError("a record's payload does not fit its checksum")
    return ids


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, files: int) -> DataFrame:
    """Encode every whole text, append ``end_id``, write records in ascending doc_id order; return the index.

    File k holds a range of (doc_id, text hash), so files in name order are in doc_id order; the hash only spreads
    a doc_id that very many rows share. Null text: empty (just the end id). Null doc_ids come first. Repeated rows
    are records of their own.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(tokenizer_path)
        dtype = np.dtype("<u2" if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.rec"
        store, top = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(top, recursive=True)
        place = records = ids_before = 0
        out = None
        try:
            for batch in slices(batches, "text"):
                out = out or store.open_output_stream(f"{top}/{name}")
                ids, sizes = enc.encode(*utf8(batch.column("text")))
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, end_id).astype(dtype)
                sizes = sizes + 1
                raw, at = frame(ids, sizes)
                out.write(raw)
                n = batch.num_rows
                yield pa.record_batch([
                    pa.array([name] * n), pa.array(np.arange(records, records + n, dtype=np.int32)), pa.array(at + place), pa.array(sizes.astype(np.int64)),
                    pa.array(ids_before + np.cumsum(sizes) - sizes), batch.column("doc_id").cast(pa.int64()), pa.array([dtype.itemsize] * n, pa.int32())], schema=_INDEX_ARROW)
                place, records, ids_before = place + len(raw), records + n, ids_before + int(sizes.sum())
        finally:
            if out is not None:
                out.close()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("spread"))
    rows = rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "spread").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "spread")
    rows.select("doc_id", "text").mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read back the records that ``index`` names, check them, and return ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all files before (one total for each file: bounded by the number of files) and of
    the records before in the same file.
    """
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    before, total = {}, 0
    for row in totals:
        before[row.file], total = total, total + row.n

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for batch in batches:
            if not batch.num_rows:
                continue
            dtype = np.dtype(f"<u{batch.column('width')[0].as_py()}")  # the same in the whole index
            names = np.array(batch.column("file").to_pylist())
            at, sizes = (batch.column(c).to_numpy().astype(np.int64) for c in ("at", "n_tokens"))
            # Neighbours in one file are fetched together, about 4 MB at once.
            group = np.cumsum(np.concatenate([[0], (names[1:] != names[:-1]) | (np.diff(at) != sizes[:-1] * dtype.itemsize + 16)])) * (1 << 40) + at // (4 << 20)
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(at)]])
            crcs = np.zeros(len(at), np.int64)
            for b, e in zip(bounds[:-1], bounds[1:]):
                with store.open_input_file(f"{top}/{names[b]}") as f:
                    f.seek(int(at[b]))
                    raw = f.read(int(at[e - 1] + sizes[e - 1] * dtype.itemsize + 16 - at[b]))
                ids = unframe(raw, at[b:e] - at[b], sizes[b:e], dtype).astype("<u4")
                ends = np.cumsum(sizes[b:e])
                crcs[b:e] = [zlib.crc32(ids[s:t]) for s, t in zip(ends - sizes[b:e], ends)]
            first = np.array([before[x] for x in names], np.int64)
            start = first + batch.column("start_in_file").to_numpy()
            yield pa.record_batch([batch.column("file"), batch.column("doc_id"), pa.array(start), batch.column("n_tokens"), pa.array(crcs)], schema=_RESULT_ARROW)

    return index.mapInArrow(read, "file string, doc_id long, start long, n_tokens long, ids_crc32 long").drop("file")


def token_records(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, files: int | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token records and read them back: doc_id, start, n_tokens, ids_crc32.

    An empty table gives an empty result. Further columns are not read, whatever their names.
    """
    folder = folder or scratch(spark, "records")
    index = write_records(docs, folder, tokenizer_path, end_id, files or int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read_records(index, folder)
