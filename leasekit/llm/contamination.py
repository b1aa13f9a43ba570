"""Operator 3: benchmark decontamination by size-partitioned MinHash containment search.

A benchmark item is contained in a document if at least ``containment`` of the item's different word shingles occur in
it (five words, 0.8 by default), wherever and in whatever order.

*Sketches.* One hash permutation orders all shingles. Items are partitioned by their number of shingles (powers of two);
an item's sketch is its k smallest hashes, k = (shingles that an item of the partition's upper size may lack) + 1. A
document that contains the item lacks at most k - 1 of its shingles, so it has at least one hash of the sketch: the
search misses nothing. A long document needs no windows, since its size plays no part.

*Search.* Each document is read once, whole. Its shingle hashes are probed against two bit tables of fixed size, of all
sketch hashes and of all item hashes. A document with no sketch hit emits nothing; else it emits its different shingles
that hit the item table, as text.

*Verification.* Emitted shingles join the items' shingles on their text; a pair counts if one of the shared shingles is
in the item's sketch and the number shared reaches the item's bound. False hits of the bit tables match no text.

Words are runs of ASCII letters and digits and of all non-ASCII characters; case is folded for ASCII and Latin-1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from leasekit.llm.common import hidden, slices, utf8, written
from leasekit.llm.words import split_words, windows

_WORD = bytes(int(b >= 128 or chr(b).isalnum()) for b in range(256))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bits of a hash that address the bit tables (so they never exceed 4 million bits each).
TABLE_BITS = 22
#: Item shingles up to which the verification join broadcasts them; beyond, it is a shuffle join.
BROADCAST_ROWS = 200_000


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and U+00C0-U+00DE (but the multiplication sign), byte by byte."""
    data = np.frombuffer(data.tobytes().translate(_FOLD), np.uint8).copy()
    last = data[1:]
    capital = (data[:-1] == 0xC3) & (last >= 0x80) & (last <= 0x9E) & (last != 0x97)
    last[capital] += 32
    return data


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of every shingle: mixed 64-bit hash, first word, text; then word codes and the different words."""
    words, counts, _ = split_words(data, offsets, _WORD)
    codes = words.indices.to_numpy(zero_copy_only=False)
    each = np.array([xxh64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)[codes] if len(codes) else np.zeros(0, np.uint64)
    first, text = windows(counts, size)
    hashes = np.zeros(len(first), np.uint64)
    for k in range(size):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + each[first + k]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    return hashes, first, text, codes, words.dictionary


def _texts(first: np.ndarray, codes: np.ndarray, words: pa.Array, size: int) -> list[str]:
    return [b" ".join(words[int(c)].as_py() for c in codes[f:f + size]).decode() for f in first]


def item_shingles(items: DataFrame, size: int, containment_percent: int) -> DataFrame:
    """``item_id, shingle, hash, n_shingles, needed, in_sketch`` of each item's different shingles."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, first, text, codes, words = shingle_hashes(*(lambda d, o: (fold(d), o))(*utf8(batch.column("text"))), size)
            yield pa.record_batch([batch.column("item_id").take(pa.array(text)), pa.array(_texts(first, codes, words, size), pa.string()), pa.array(hashes.view(np.int64))], names=["item_id", "shingle", "hash"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(make, f"item_id {kind}, shingle string, hash long").distinct()
    n = F.col("n_shingles")
    upper = F.pow(F.lit(2.0), F.length(F.bin(n))).cast("long") - 1  # of the item's size partition
    least = lambda count: F.ceil(count * containment_percent / 100).cast("long")
    # Hash order as unsigned: flip the sign bit.
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("hash").bitwiseXOR(F.lit(-(1 << 63))), "shingle"))
    found = found.withColumn("n_shingles", F.count("*").over(Window.partitionBy("item_id"))).withColumn("rank", rank)
    return found.select("item_id", "shingle", "hash", "n_shingles", least(n).alias("needed"), (F.col("rank") <= upper - least(upper) + 1).alias("in_sketch"))


def contaminated(docs: DataFrame, items: DataFrame, size: int = 5, containment_percent: int = 80) -> DataFrame:
    """``doc_id, text_hash, item_id, n_shared, n_shingles`` of every document and item it contains.

    Null or empty texts, and items of under ``size`` words, have no shingles and match nothing; equal rows count once;
    items with one item_id count as one set; null ids are ids like any other. Further columns are not read.
    """
    spark = docs.sparkSession
    shingles = written(item_shingles(items, size, containment_percent), "item-shingles")
    address = F.shiftrightunsigned("hash", 64 - TABLE_BITS)
    tables = np.zeros((2, 1 << TABLE_BITS), bool)
    for row in shingles.groupBy(address.alias("at")).agg(F.max("in_sketch").alias("s")).toLocalIterator():  # at most 2**TABLE_BITS rows
        tables[0, row.at], tables[1, row.at] = row.s, True
    tables = spark.sparkContext.broadcast(np.packbits(tables, axis=1))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, every = (t.view(bool) for t in np.unpackbits(tables.value, axis=1))
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            hashes, first, text, codes, words = shingle_hashes(fold(data), offsets, size)
            at = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            suspect = np.zeros(batch.num_rows, bool)
            suspect[text[sketch[at]]] = True
            hit = np.flatnonzero(every[at] & suspect[text])
            if len(hit):
                _, once = np.unique(np.stack([text[hit].astype(np.uint64), hashes[hit]]), axis=1, return_index=True)
                hit = hit[once]
            ids = pa.array(text[hit])
            yield pa.record_batch([batch.column("doc_id").take(ids), batch.column("text_hash").take(ids), pa.array(_texts(first[hit], codes, words, size), pa.string())], names=["doc_id", "text_hash", "shingle"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(probe, f"doc_id {kind}, text_hash long, shingle string")
    known = shingles.drop("hash")
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    shared = hits.join(known, "shingle").groupBy("doc_id", "text_hash", "item_id", "n_shingles", "needed")
    # Equal rows emit each shingle once each: count different ones.
    found = shared.agg(F.count_distinct("shingle").alias("n_shared"), F.max("in_sketch").alias("met"))
    return found.where("met and n_shared >= needed").select("doc_id", "text_hash", "item_id", "n_shared", "n_shingles")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 5, containment_percent: int = 80) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    inner, restore = hidden(docs, ["doc_id", "text"])
    found = contaminated(inner, items, size, containment_percent).select("doc_id", "text_hash").distinct()
    found = found.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
    keyed = inner.withColumn("text_hash", F.xxhash64("text"))
    return restore(keyed.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left_anti"))
