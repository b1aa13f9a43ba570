"""Operator 8: SimHash near-duplicates by pivot distance tables.

A document's fingerprint has 64 bits; two fingerprints link if they differ in at most ``max_bits`` bits. Copies share a
fingerprint, so all search runs over the different fingerprints, and classes expand to documents at the end.

*Pivot tables.* ``REFERENCES`` fixed random fingerprints are the pivots. The bits fall into ``max_bits`` + 3 bands, and
for each fingerprint the table holds its Hamming distance to every pivot within every band; a distance to a pivot is
the sum over bands. By the triangle inequality two fingerprints at most ``max_bits`` apart differ by at most
``max_bits`` in every such coordinate. Besides, their differing bits touch at most ``max_bits`` bands, so in at least
three bands *all* coordinates are equal.

*Search.* For each choice of three bands, fingerprints meet whose coordinates there are equal (an equi-join, no pair
of unlike vectors is ever made). Of the pairs that meet, those are discarded whose largest coordinate difference over
the whole-fingerprint distances exceeds ``max_bits``; survivors are verified on the fingerprints. The search is exact.

*Hot cells.* A cell (three bands' coordinates) with more than ``CELL`` fingerprints makes no pairs. Its members are
told apart by finer pivots, the single bits of the other bands: for each choice of ``max_bits`` of those bits, members
equal in all other bits meet. At most 2**max_bits fingerprints can, and all of them link. Work stays in proportion to
the members, and no link is lost.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from leasekit.llm.common import hidden, slices, utf8, written
from leasekit.llm.graph import components

REFERENCES = [random.Random(f"pivot {k}").getrandbits(64) for k in range(16)]
#: Members of a cell from which finer pivots take the place of pairs.
CELL = 256
#: Bytes of one text whose words are handled at once.
BLOCK = 4 << 20
_WEIGHTS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def word_blocks(text: bytes, keep: int) -> Iterator[list[bytes]]:
    """Words of a text in blocks of bounded size; each block starts with the last ``keep`` words of the one before."""
    last: list[bytes] = []
    at = 0
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and text[end] not in b"\t\n\x0b\x0c\r ":
            end += 1
        words = last + text[at:end].split()
        at = end
        yield words
        last = words[len(words) - keep:] if len(words) >= keep else words


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """SimHash of a text's word shingles (repeats count): bit k is set if it is in over half of the shingles' XXH64.

    A text with fewer words than a shingle has one shingle, all its words, whatever its size."""
    counts, total = np.zeros(64, np.int64), 0
    text = text.lower()  # bytes: A-Z only
    few: list[bytes] = []
    for words in word_blocks(text, shingle - 1):
        if len(words) < shingle:
            few = words  # with fewer words than a shingle so far, a block starts with all of them
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts, ends = [0, *ends[:len(words) - shingle].tolist()], (ends[shingle - 1:] - 1).tolist()
        hashes = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, ends)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
    if not total and few:  # the whole sequence is the shingle
        return xxh64_intdigest(b" ".join(few), seed)
    return int(_WEIGHTS[2 * counts > total].sum()) if total else 0


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row. Null, empty or blank text has fingerprint 0, like any other."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            found = np.array([fingerprint(raw[b:e], shingle) for b, e in zip(offsets[:-1], offsets[1:])], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(make, f"doc_id {kind}, text_hash long, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _distance(fp: Column, reference: int, mask: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(reference))).bitwiseAND(F.lit(_signed(mask))))


def _bands(count: int) -> list[list[int]]:
    return [list(map(int, part)) for part in np.array_split(np.arange(64), count)]


def links(fps: DataFrame, max_bits: int, cell: int = CELL) -> DataFrame:
    """Pairs ``a, b`` of the different fingerprints in ``fps`` (fp) whose transitive closure is that of all pairs at most
    ``max_bits`` bits apart; every pair returned is a link."""
    bands = _bands(max_bits + 3)
    masks = [sum(1 << bit for bit in band) for band in bands]
    fp = F.col("fp")
    # Four bits hold a distance within a band of up to 15 bits, so a band's 16 coordinates make one long.
    wide = max(map(len, bands)) > 15
    sign = [F.xxhash64(*(_distance(fp, r, m) for r in REFERENCES)) if wide else sum((F.shiftleft(_distance(fp, r, m).cast("long"), 4 * k) for k, r in enumerate(REFERENCES[1:], 1)), _distance(fp, REFERENCES[0], m).cast("long")) for m in masks]
    signed = fps.select("fp", *(s.alias(f"s{k}") for k, s in enumerate(sign)))
    choices = list(combinations(range(len(bands)), 3))
    cells = signed.select("fp", F.posexplode(F.array(*(F.xxhash64(F.lit(n), *(F.col(f"s{k}") for k in choice)) for n, choice in enumerate(choices)))).alias("choice", "cell"))
    sizes = cells.groupBy("choice", "cell").agg(F.count("*").alias("n")).where("n > 1")
    met = written(cells.join(sizes, ["choice", "cell"]), "cells")

    few = met.where(F.col("n") <= cell).select("choice", "cell", "fp", F.array(*(_distance(fp, r, (1 << 64) - 1).cast("byte") for r in REFERENCES)).alias("d"))
    a = few.select("choice", "cell", F.col("fp").alias("a"), F.col("d").alias("da"))
    b = few.select("choice", "cell", F.col("fp").alias("b"), F.col("d").alias("db"))
    farthest = F.greatest(*(F.abs(F.col("da")[k] - F.col("db")[k]) for k in range(len(REFERENCES))))
    pairs = a.join(b, ["choice", "cell"]).where(F.col("a") < F.col("b")).where(farthest <= max_bits)
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")

    # Bits that a hot cell does not fix, by choice; keep all bits but max_bits of them.
    free = [[bit for k, band in enumerate(bands) if k not in choice for bit in band] for choice in choices]
    kept = [[_signed(((1 << 64) - 1) & ~sum(1 << bit for bit in some)) for some in combinations(bits, max_bits)] for bits in free]
    hot = met.where(F.col("n") > cell)
    masks_of = fps.sparkSession.createDataFrame([(n, m) for n, ms in enumerate(kept) for m in ms], "choice int, mask long")
    fine = hot.join(F.broadcast(masks_of), "choice").select("fp", "mask", fp.bitwiseAND(F.col("mask")).alias("rest"))  # a fixed table of masks
    first = fine.groupBy("mask", "rest").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z")
    hot_pairs = fine.join(first, ["mask", "rest"]).where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(hot_pairs).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` of every row of ``docs`` (doc_id, text).

    ``root`` names the class of documents reachable by links; ``component_id`` is its smallest doc_id. Null doc_ids take
    part but never name a class (all null: null). Repeated rows each stay; an empty table gives an empty result; further
    columns are not read.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = components(links(classes.select("fp"), max_bits))
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Most classes are alone; only those in a component of several are grouped again.
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(smallest, "root"), "fp")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` without near-duplicates: of each class the row with the smallest doc_id stays (one without doc_id only if
    the class has no other; of rows with one doc_id the smallest text hash; of equal rows one)."""
    inner, restore = hidden(docs, ["doc_id", "text"])
    key = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.coalesce("text_hash", F.lit(0)).alias("hash")]
    found = near_duplicates(inner, shingle, max_bits)
    first = found.groupBy("root").agg(F.min(F.struct(*key)).alias("first")).select("first.*")
    keyed = inner.withColumn("text_hash", F.xxhash64("text")).select("*", *key)
    return restore(keyed.join(first, ["no_id", "id", "hash"], "left_semi").dropDuplicates(["no_id", "id", "hash"]))


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
