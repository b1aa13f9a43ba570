"""Operator 13: ranked lexical search, an exact inner-product search in sparse ball trees.

A document is a sparse vector of integers, one for each different term (``gain``: how much the term's occurrences are
worth in a document of this length), an item a sparse vector of integer term weights times repeats; a score is their inner
product. All documents are read once; of each only the terms of some item are kept, which leaves every inner product as
it is, and the number of its terms. Document frequencies, the number of documents and of terms are sums over all of them.

*Trees.* Every task puts its documents' vectors, some ``TREE`` entries at a time, into a ball tree: a node holds the
centroid and the radius of its documents; a node is cut between its farthest document and the one farthest from that.

*Bounds.* No document of a node scores more than q·centroid + |q|·radius. Radii and bounds are in doubles and raised by
more than their rounding can lose, so an integer score never exceeds its bound. Nodes are taken best bound first; when
the best bound left lies under the task's last kept score, no document left can be among the first (a bound equal to
it goes on, as ties are ranked by doc_id). Leaves are scored in 64-bit integers.

Items are taken in blocks of a bounded number of terms, each against all documents; every task gives its first documents
of each item, and these are ranked again by Spark.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leasekit.llm.common import BATCH_BYTES, runs, slices, utf8, written
from leasekit.llm.words import split_words

#: Terms are runs of these bytes: digits, ASCII letters and every byte of longer UTF-8 sequences.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = bytes(int(b >= 128 or chr(b).isalnum()) for b in range(256))
#: Different (item, term) rows of a block of items, about.
BLOCK_TERMS = 1 << 20
#: Vector entries of one tree, at most (a document with more makes a tree of its own); documents of a leaf.
TREE, LEAF = 1 << 20, 256
#: Parts of the tasks' results of an item that are ranked before the whole.
PARTS = 32
_EPS = float(np.finfo(np.float64).eps)


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, n``: how often an item has each term. Different texts with one item_id count as one item."""
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = items.select("item_id", "text").distinct().select("item_id", F.explode(F.regexp_extract_all(folded, F.lit(TERM_PATTERN), F.lit(0))).alias("term"))
    return terms.groupBy("item_id", "term").agg(F.count("*").alias("n"))


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end between terms."""
    at = 0
    while at < len(data):
        end = at + BATCH_BYTES
        while end < len(data) and _TERM[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def _counts(data: np.ndarray, offsets: np.ndarray, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text; and text, term (its place in ``known``) and count of what is known of them."""
    words, each, _ = split_words(np.frombuffer(data.tobytes().lower(), np.uint8), offsets, _TERM)  # bytes: A-Z only
    place = pc.index_in(words.dictionary, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
    place = place[words.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(each)), each)[place >= 0]
    keys, tf = np.unique(text * len(known) + place[place >= 0], return_counts=True)
    return each, keys // max(len(known), 1), keys % max(len(known), 1), tf


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, n_terms, terms, counts`` of every document: its number of terms, and which of ``terms`` (places, 32-bit
    integers) it has how often (64-bit integers). A long text is read piece by piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array([t.encode() for t in terms], pa.large_binary())
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            if len(data) > 2 * BATCH_BYTES:  # one long text
                n, total = 0, np.zeros(len(terms), np.int64)
                for piece in _pieces(data):
                    each, _, place, tf = _counts(piece, np.array([0, len(piece)]), known)
                    n += int(each.sum())
                    total[place] += tf
                place = np.flatnonzero(total)
                each, text, tf = np.array([n]), np.zeros(len(place), np.int64), total[place]
            else:
                each, text, place, tf = _counts(data, offsets, known)
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())
            yield pa.record_batch([batch.column("doc_id"), pa.array(each.astype(np.int64)), cut(place.astype("<i4")), cut(tf.astype("<i8"))], names=["doc_id", "n_terms", "terms", "counts"])

    return docs.select("doc_id", "text").mapInArrow(make, f"doc_id {kind}, n_terms long, terms binary, counts binary")


def document_frequencies(found: DataFrame, n: int) -> np.ndarray:
    """In how many documents each of the ``n`` terms is: sums in the tasks, then over tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n, np.int64)
        for batch in batches:
            for terms in batch.column("terms"):
                df[np.frombuffer(terms.as_py(), "<i4")] += 1
        some = np.flatnonzero(df)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])

    df = np.zeros(n, np.int64)
    sums = found.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()  # a row a term of the block
    df[sums["term"]] = sums["df"]
    return df


def gain(tf: np.ndarray, n_terms: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Vector entries: of terms with ``tf`` occurrences in documents of ``n_terms`` terms."""
    lengths, which = np.unique(n_terms, return_inverse=True)
    m = np.array([25 + 75 * int(n) * documents // terms for n in lengths], np.int64)  # Python integers: no overflow
    return 1_000_000_000 * tf // (1000 * tf + 8 * m[which])


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class BallTree:
    """A sparse matrix (``first``, ``place``, ``value``) with its rows in the ``order`` of the leaves, and its nodes."""

    first: np.ndarray
    place: np.ndarray
    value: np.ndarray
    order: np.ndarray
    begin: list[int]
    end: list[int]
    children: list[tuple[int, int] | None]
    centroid: list[tuple[np.ndarray, np.ndarray]]
    radius: list[float]

    def bound(self, node: int, q: np.ndarray, norm: float) -> float:
        """At least the inner product of ``q`` with every row of the node."""
        place, value = self.centroid[node]
        exact = float(q[place] @ value) + norm * self.radius[node]
        return exact * (1 + (8 + len(place)) * 4 * _EPS)


def _rows(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of some rows, and the place of each row's first among them."""
    sizes = first[rows + 1] - first[rows]
    return np.repeat(first[rows], sizes) + runs(sizes), np.concatenate([[0], np.cumsum(sizes)])


def ball_tree(first: np.ndarray, place: np.ndarray, value: np.ndarray, width: int, leaf: int = LEAF) -> BallTree:
    """A ball tree of the rows, each with at least one entry; columns are 0 to ``width`` - 1."""
    n = len(first) - 1
    order = np.arange(n)
    squares = np.add.reduceat(value.astype(np.float64) ** 2, first[:-1]) if n else np.zeros(0)
    slack = 4 * _EPS * (8 + (int(np.diff(first).max()) if n else 0) + n)
    tree = BallTree(first, place, value, order, [], [], [], [], [])

    def add(begin: int, end: int) -> int:
        tree.begin.append(begin)
        tree.end.append(end)
        tree.children.append(None)
        tree.centroid.append((np.zeros(0, np.int64), np.zeros(0)))
        tree.radius.append(0.0)
        return len(tree.begin) - 1

    todo = [add(0, n)] if n else []
    dense = np.zeros(width)
    while todo:
        node = todo.pop()
        begin, end = tree.begin[node], tree.end[node]
        rows = order[begin:end]
        at, starts = _rows(first, rows)
        columns, entries = place[at], value[at].astype(np.float64)
        centre = np.bincount(columns, entries, width) / len(rows)
        some = np.flatnonzero(centre)
        tree.centroid[node] = (some, centre[some])
        inner = np.add.reduceat(entries * centre[columns], starts[:-1])
        square = float(centre[some] @ centre[some])
        away = squares[rows] - 2 * inner + square
        tree.radius[node] = math.sqrt(max(float(away.max()), 0.0) + slack * (float(squares[rows].max()) + square)) * (1 + 4 * _EPS)
        if len(rows) <= leaf or away.max() <= slack * (squares[rows].max() + square):
            continue  # few rows, or all the same

        def distances(row: int) -> np.ndarray:
            own = slice(first[row], first[row + 1])
            dense[place[own]] = value[own]
            inner = np.add.reduceat(entries * dense[columns], starts[:-1])
            dense[place[own]] = 0
            return squares[rows] - 2 * inner + squares[row]

        to_one = distances(rows[int(away.argmax())])
        nearer = to_one - distances(rows[int(to_one.argmax())])
        left = nearer <= 0
        if min(left.sum(), (~left).sum()) * 16 < len(rows):  # no long chains of nodes: halves by rank
            left = np.zeros(len(rows), bool)
            left[np.argsort(nearer, kind="stable")[:len(rows) // 2]] = True
        order[begin:end] = np.concatenate([rows[left], rows[~left]])
        middle = begin + int(left.sum())
        tree.children[node] = (add(begin, middle), add(middle, end))
        todo += tree.children[node]
    if n:  # from now on a node's rows and entries lie together
        at, tree.first = _rows(first, order)
        tree.place, tree.value = place[at], value[at]
    return tree


def best_rows(tree: BallTree, q: np.ndarray, least: int, offer: Callable[[np.ndarray, np.ndarray], int]) -> int:
    """Offers ``offer(rows, scores) -> least`` every row that may score at least ``least`` (it may raise it); returns the
    number of nodes seen. ``q`` holds integers."""
    if not tree.begin:
        return 0
    norm = math.sqrt(float(q.astype(np.float64) @ q)) * (1 + 8 * _EPS * (8 + len(q)))
    heap = [(-tree.bound(0, q, norm), 0)]
    seen = 0
    while heap:
        bound, node = heapq.heappop(heap)
        if math.floor(-bound) < least:
            break
        seen += 1
        if (two := tree.children[node]) is not None:
            for child in two:
                heapq.heappush(heap, (-tree.bound(child, q, norm), child))
            continue
        begin, end = tree.begin[node], tree.end[node]
        a, b = tree.first[begin], tree.first[end]
        scores = np.add.reduceat(q[tree.place[a:b]] * tree.value[a:b], tree.first[begin:end] - a)
        hit = scores >= least
        if hit.any():
            least = offer(tree.order[begin:end][hit], scores[hit])
    return seen


def _search(found: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], documents: int, terms: int, top: int) -> DataFrame:
    """``query, doc_id, score`` of each task's first ``top`` documents of every query (terms' places and weights)."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in queries]
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            lengths = np.diff(np.frombuffer(batch.column("terms").cast(pa.large_binary()).buffers()[1], np.int64, batch.num_rows + 1, 8 * batch.column("terms").offset)) // 4
            ends = np.cumsum(lengths)
            start = 0
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TREE, "right")))
                grow(batch.slice(start, end - start), best)
                start = end
        rows = [(k, i, s) for k, kept in enumerate(best) for s, _, i in kept]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type), pa.array([-r[2] for r in rows], pa.int64())], names=["query", "doc_id", "score"])

    def grow(batch: pa.RecordBatch, best: list[list[tuple]]) -> None:
        held = [(np.frombuffer(t, "<i4"), np.frombuffer(c, "<i8")) for t, c in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist())]
        sizes = np.array([len(t) for t, _ in held])
        rows = np.flatnonzero(sizes)
        if not len(rows):
            return
        ids = batch.column("doc_id").take(pa.array(rows)).to_pylist()
        place, tf = (np.concatenate([held[r][k] for r in rows]) for k in (0, 1))
        n_terms = batch.column("n_terms").to_numpy(zero_copy_only=False)[rows]
        value = gain(tf.astype(np.int64), np.repeat(n_terms, sizes[rows]), documents, terms)
        here, place = np.unique(place, return_inverse=True)  # the tree's own columns
        tree = ball_tree(np.concatenate([[0], np.cumsum(sizes[rows])]), place, value, len(here))
        for k, (q_place, q_value) in enumerate(queries):
            q = np.zeros(len(here), np.int64)
            at = np.minimum(np.searchsorted(here, q_place), len(here) - 1)
            hit = here[at] == q_place
            q[at[hit]] = q_value[hit]
            if not q.any():
                continue
            kept = best[k]

            def offer(rows: np.ndarray, scores: np.ndarray, kept: list[tuple] = kept) -> int:
                # smallest first: score falling, null ids last, doc_id rising
                if len(rows) > top:  # rows under the leaf's own last place cannot be kept
                    some = scores >= np.partition(scores, -top)[-top]
                    rows, scores = rows[some], scores[some]
                kept += [(-int(s), ids[r] is None, ids[r]) for r, s in zip(rows, scores)]
                kept.sort(key=lambda x: (x[0], x[1], x[2]) if not x[1] else (x[0], True))
                del kept[top:]
                return -kept[-1][0] if len(kept) == top else 1

            best_rows(tree, q, -kept[-1][0] if len(kept) == top else 1, offer)

    return found.mapInArrow(run, f"query int, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's ``top`` highest-scoring rows of ``docs`` (doc_id, text), score above 0.

    Equal scores by ascending doc_id, null ids last; equal rows are documents of their own, next to each other in rank. A
    document without a term of the item is not returned; null and empty texts have no terms. Equal rows of ``items`` count
    once, different texts with one item_id (null is an id like any other) make one item. Empty tables give an empty
    result; further columns are not read.
    """
    spark = docs.sparkSession
    terms = written(item_terms(items), "item-terms")
    blocks = -(-terms.count() // BLOCK_TERMS)
    item, kind = (t.schema[c].dataType.simpleString() for t, c in ((items, "item_id"), (docs, "doc_id")))
    out = spark.createDataFrame([], f"item_id {item}, rank int, doc_id {kind}, score long")
    for block in range(blocks):  # an item's terms are all in one block
        asked = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        known = sorted({t.term for t in asked})
        if not known:
            continue
        place = {t: k for k, t in enumerate(known)}
        found = written(vectors(docs, known), "term-vectors")
        total = found.agg(F.count_if(F.col("n_terms") > 0), F.sum("n_terms")).first()
        documents, n_terms = int(total[0]), int(total[1] or 0)
        df = document_frequencies(found, len(known))
        weights = [weight(int(n), documents) for n in df]
        groups: dict = {}
        for t in asked:
            groups.setdefault(t.item_id, []).append((place[t.term], t.n * weights[place[t.term]]))
        queries = [tuple(np.array(x, np.int64) for x in zip(*sorted(g))) for g in groups.values()]
        local = _search(found.where(F.octet_length("terms") > 0).select("doc_id", "n_terms", "terms", "counts"), queries, documents, max(n_terms, 1), top)
        by = [F.desc("score"), F.asc_nulls_last("doc_id")]
        part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
        local = local.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*by))).where(F.col("rank") <= top)
        ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*by))).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(groups)), f"query int, item_id {item}")
        out = out.unionByName(written(ranked.join(names, "query").select("item_id", "rank", "doc_id", "score"), "ranked"))
    return out
