"""Operator 5: bulk-synchronous best-fit packing of documents into sequences of at most ``capacity`` tokens.

1. Every text is encoded, ended and cut into pieces of at most ``capacity`` ids; only (doc_id, piece, start, length,
   ids_crc32) go on.
2. Pieces are range-sorted by length, longest first. Pieces of one length are interchangeable, and a gap is a number
   from 0 to ``capacity``: the packing state is a table of runs (length, pieces) and a table of runs (gap, sequences),
   of at most ``capacity`` + 1 different lengths whatever the input's size.
3. Rounds: the longest pieces not yet placed sweep the gaps in ascending order, each run taking the smallest gap that
   holds it (its successor); pieces in rank order take the sequences of that gap in rank order (conflicts go to the
   lower rank, the rest tries the next gap or opens new sequences); gaps are updated, and the next round begins.
   A round yields intervals of ranks with a sequence and an offset as a linear function of the rank.
4. The intervals (a few for each length) go to all tasks, which place each piece by its (length, rank).

The result is exactly best-fit decreasing over all pieces, with no data rows on the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasekit.llm.common import runs, slices, utf8, written
from leasekit.llm.segments import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece of a document's ids followed by ``end_id``. Null text: empty, so one piece of one id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in slices(batches, "text"):
            ids, sizes = enc.encode(*utf8(batch.column("text")))
            ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
            sizes = sizes + 1
            count = -(-sizes // capacity)
            doc, piece = np.repeat(np.arange(len(sizes)), count), runs(count)
            start = piece * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            first = (np.cumsum(sizes) - sizes)[doc] + start
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(first, first + length)]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], schema=_PIECES_ARROW)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rounds of best-fit over runs. Returns intervals (length, first rank, first sequence, pieces per sequence,
    offset), which hold up to the next interval of that length, and the number of sequences."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, count)
    order: list[int] = []  # gaps that exist, ascending
    out, opened = [], 0

    def put(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(order, length)
            if at < len(order):
                gap = order[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:  # no gap holds it: open sequences
                each = capacity // length
                first, count, gap = opened, -(-left // each), capacity
                opened += count
            each = gap // length  # the sequence just used stays the tightest for pieces of this length while it holds one
            full = min(count, left // each)
            rest = min(left - full * each, each) if full < count else 0
            out.append((length, rank, first, each, capacity - gap))
            put(gap - each * length, first, full)
            if rest:
                put(gap - rest * length, first + full, 1)
            put(gap, first + full + (rest > 0), count - full - (rest > 0))
            rank, left = rank + full * each + rest, left - full * each - rest
    return out, opened


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack all ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null or empty text makes a piece of the end id alone; repeated rows are packed each; an empty table gives an empty
    result; further columns are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = written(pieces(docs, tokenizer_path, capacity, end_id), "pieces")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rank among the pieces of the same length in this range."""
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            new = np.concatenate([[True], length[1:] != length[:-1]])
            begin = np.flatnonzero(new)
            rank = np.arange(len(length)) - np.repeat(begin, np.diff(np.append(begin, len(length))))
            if length[0] == last:
                head = begin[1] if len(begin) > 1 else len(length)
                rank[:head] += seen
            last, seen = length[-1], int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(rank.astype(np.int64))], names=[*batch.schema.names, "part", "rank_in_part"])

    # doc_id, piece and crc only spread a length that very many pieces share.
    keys = [F.col("length").desc(), "doc_id", "piece", "ids_crc32"]
    ranked = written(made.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(number, PIECES + ", part int, rank_in_part long"), "ranked")
    # At most one row for each length and one more for each range.
    count = ranked.groupBy("length", "part").agg(F.count("*").alias("n")).orderBy("length", "part").collect()
    totals: dict[int, int] = {}
    before: dict[int, tuple[list[int], list[int]]] = {}
    for length, part, n in count:
        where = before.setdefault(length, ([], []))
        where[0].append(part)
        where[1].append(totals.get(length, 0))
        totals[length] = totals.get(length, 0) + n
    found, _ = plan(totals, capacity)
    table = np.array(sorted(found), np.int64).reshape(-1, 5)
    shift = np.array([(length, part, n) for length, (parts_, ns) in before.items() for part, n in zip(parts_, ns)], np.int64).reshape(-1, 3)
    shift = shift[np.lexsort((shift[:, 1], shift[:, 0]))]
    bits = 44  # ranks below 2**44, lengths above it
    plan_keys, shift_keys = (table[:, 0] << bits) + table[:, 1], (shift[:, 0] << bits) + shift[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, part, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "part", "rank_in_part"))
            rank = rank + shift[np.searchsorted(shift_keys, (length << bits) + part), 2]
            row = table[np.searchsorted(plan_keys, (length << bits) + rank, "right") - 1]
            place_, each = rank - row[:, 1], row[:, 3]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _PIECES_ARROW.names), pa.array(row[:, 2] + place_ // each), pa.array(row[:, 4] + place_ % each * length)], names=[*_PIECES_ARROW.names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
