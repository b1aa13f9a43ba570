"""Exact k-nearest-neighbour join and regressor.

Exact all-pairs k-NN is quadratic by nature; the job is to spread that work
evenly, never to materialise the pairs and never to copy rows. References are
written once, in shards of bounded size, as files of the shared folder; query
rows are dealt to tasks once, and a task fetches one shard after another for a
block of its queries and keeps the k best so far.

Rows that are near to each other meet in one shard, and in one block of
queries: a tree of medians, found from some of the references, tells every row
its place. A shard has a box, the least and greatest value of each entry; a box
that is farther from a query than the last of its k best so far holds none of
its neighbours, whatever the rows are, so a block takes the shards from the
nearest box on and leaves out what is too far. The tree decides only how much
is left out, never what is found: with rows in which nothing can be left out all
pairs are looked at.

A matrix product in 32 bits, with a bound on its rounding error, tells which
references of a shard can be among the first; only for these is the distance
taken as the root of summed squared differences. Shuffled and written data grow
with the rows, not with their product.
"""
from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leasekit.session import _tables

CAND_SCHEMA = "qid long, rid long, dist double, label double, near double"

#: Bytes of query vectors that a task holds at once, and products or candidate pairs that it looks at together.
QUERY_BYTES, PRODUCTS, PAIRS = 16 << 20, 1 << 21, 1 << 17
#: References from which the tree of medians is made, and the most leaves it has.
TREE_ROWS, TREE_LEAVES = 1 << 14, 1 << 10
#: Queries of a block, and those of a part of it that have a box of their own.
BLOCK_QUERIES, PART_QUERIES = 4096, 64
#: Bytes of shards that a task keeps for its next block.
SHARD_BYTES = 128 << 20


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _blocks(batches: Iterator[pa.RecordBatch], vec: str, rows: int | None = None) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows with a matrix of their vectors (null entries: NaN), ``rows`` at a time or as many as QUERY_BYTES hold."""
    held, n = [], 0

    def block(part: pa.Table):
        lists = part.column(vec).combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        if (sizes != sizes[0]).any():
            raise ValueError(f"vectors of {sizes.min()} to {sizes.max()} entries")
        return part.drop_columns([vec]), lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(sizes), -1)

    for batch in batches:
        if not batch.num_rows:
            continue
        most = rows or max(1, QUERY_BYTES // (8 * max(1, len(batch.column(vec)[0]))))
        held.append(batch)
        n += batch.num_rows
        while n >= most:
            whole = pa.Table.from_batches(held)
            yield block(whole.slice(0, most))
            held, n = whole.slice(most).to_batches(), n - most
    if n:
        yield block(pa.Table.from_batches(held))


# ------------------------------------------------------------------ places
def _halves(x: np.ndarray) -> tuple[int, float] | None:
    """The entry whose values differ most and a cut that leaves rows on both sides; None if all rows are the same."""
    spread = x.var(0) if len(x) else np.zeros(0)
    for d in np.argsort(-spread, kind="stable"):
        low, high = x[:, d].min(), x[:, d].max()
        if low >= high:
            return None
        cut = np.partition(x[:, d], (len(x) - 1) // 2)[(len(x) - 1) // 2]
        return int(d), float(cut if cut < high else np.max(x[x[:, d] < high, d]))
    return None


def _median_tree(x: np.ndarray, least: int) -> list[tuple[int, float, int, int]]:
    """Nodes (entry, cut, left, right) of a tree that halves rows; a leaf has entry -1 and its number as cut."""
    nodes: list = [None]
    waiting, leaves = [(0, np.arange(len(x)))], 0
    while waiting:
        node, rows = waiting.pop()
        found = _halves(x[rows]) if len(rows) >= 2 * least else None
        if found is None:
            nodes[node], leaves = (-1, float(leaves), -1, -1), leaves + 1
            continue
        d, cut = found
        goes = x[rows, d] <= cut
        nodes[node] = d, cut, len(nodes), len(nodes) + 1
        nodes += [None, None]
        waiting += [(len(nodes) - 1, rows[~goes]), (len(nodes) - 2, rows[goes])]  # the left side first: near leaves have near numbers
    return nodes


def _leaf_of(nodes: list, x: np.ndarray) -> np.ndarray:
    """The leaf of each row; -1 for rows with an entry that is not finite."""
    entry, cut, left, right = (np.array(c) for c in zip(*nodes))
    at = np.zeros(len(x), np.int64)
    finite = np.isfinite(x).all(1)
    live = np.flatnonzero(finite & (entry[0] >= 0))
    while len(live):
        here = at[live]
        at[live] = np.where(x[live, entry[here]] <= cut[here], left[here], right[here])
        live = live[entry[at[live]] >= 0]
    return np.where(finite, cut[at], -1).astype(np.int32)


def _placed(nodes: list, vec: str, width: int):
    """Adds each row's leaf."""
    def place(batches):
        for batch in batches:
            if batch.num_rows:
                part, x = next(_blocks(iter([batch]), vec, batch.num_rows))
                if x.shape[1] != width:
                    raise ValueError(f"vectors of {x.shape[1]} entries, references of {width}")
                yield pa.record_batch([*batch.columns, pa.array(_leaf_of(nodes, x))], names=[*batch.schema.names, "leaf"])
    return place


def _parts(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows in parts of at most ``most``, near ones together."""
    out, waiting = [], [np.arange(len(x))]
    while waiting:
        rows = waiting.pop()
        found = _halves(x[rows]) if len(rows) > most else None
        if found is None:
            out += [rows[a:a + most] for a in range(0, len(rows), most)]
        else:
            goes = x[rows, found[0]] <= found[1]
            waiting += [rows[~goes], rows[goes]]
    return out


# ------------------------------------------------------------------ shards
def _write_shards(folder: str, rows: int):
    def write(batches):
        store, top = _store(folder)
        for part, vectors in _blocks(batches, "rv"):
            ids, label, leaf = part.column("rid").to_numpy(), part.column("label").to_numpy().astype(float), part.column("leaf").to_numpy()
            for of in np.split(np.arange(len(leaf)), np.flatnonzero(np.diff(leaf)) + 1):  # rows come sorted by leaf
                odd = leaf[of[0]] < 0
                for some in [of[a:a + rows] for a in range(0, len(of), rows)] if odd else [of[p] for p in _parts(vectors[of], rows)]:
                    name, data, x = uuid.uuid4().hex, io.BytesIO(), vectors[some]  # a task that runs again writes files of its own
                    np.savez(data, rid=ids[some], label=label[some], vectors=x)
                    store.create_dir(top, recursive=True)
                    with store.open_output_stream(f"{top}/{name}") as out:
                        out.write(data.getbuffer())
                    box = (np.full(x.shape[1], -np.inf), np.full(x.shape[1], np.inf)) if odd else (x.min(0), x.max(0))
                    yield pa.record_batch([pa.array([name]), *(pa.array([b.astype("<f8").tobytes()], pa.binary()) for b in box)], names=["name", "low", "high"])
    return write


class _Shards:
    """Shards of the shared folder; those read last stay, up to SHARD_BYTES."""

    def __init__(self, folder: str, names: list[str]) -> None:
        (self.store, self.top), self.names, self.held, self.bytes = _store(folder), names, {}, 0

    def __getitem__(self, s: int) -> tuple[np.ndarray, ...]:
        """Ids, labels, vectors, their squares, and (32 bits, from the middle of the shard) the vectors for the product, their
        squares and the middle."""
        if s in self.held:
            self.held[s] = self.held.pop(s)
            return self.held[s]
        with self.store.open_input_stream(f"{self.top}/{self.names[s]}") as f:
            shard = np.load(io.BytesIO(f.read()))
            rid, label, x = shard["rid"], shard["label"], shard["vectors"]
        middle = (x.min(0) + x.max(0)) / 2
        with np.errstate(invalid="ignore", over="ignore"):
            near = (x - middle).astype(np.float32)
            squares = np.einsum("ij,ij->i", near, near, dtype=float)
            whole = rid, label, x, np.einsum("ij,ij->i", x, x), near.T * np.float32(-2), squares, middle
        size = sum(v.nbytes for v in whole)
        while self.held and self.bytes + size > SHARD_BYTES:
            self.bytes -= sum(v.nbytes for v in self.held.pop(next(iter(self.held))))
        self.held[s], self.bytes = whole, self.bytes + size
        return whole


def _candidates(Q, qq, R, rr, limit, k):
    """Pairs (query, reference) that may be among the k first, by bounds of the squared distance from a matrix product."""
    with np.errstate(invalid="ignore", over="ignore"):
        size = qq[:, None] + rr
        squares = size - 2 * (Q @ R.T)
        slack = 8 * (Q.shape[1] + 8) * np.finfo(float).eps * size
        if k < len(R) and np.isinf(limit).any():
            above = np.sqrt(np.maximum(np.partition(np.nan_to_num(squares + slack, nan=np.inf), k - 1, axis=1)[:, k - 1], 0))
            limit = np.minimum(limit, above)
        # Written so that NaN (infinite entries) stays a candidate.
        return np.nonzero(~(squares - slack > (limit[:, None] * (1 + 1e-12)) ** 2))


def _near(Q, qq, shard, limit):
    """The same for finite rows and limits by a product in 32 bits of vectors from the middle of the shard: for every pair left
    out, the squared distance less all that rounding may add is above the limit."""
    _, _, _, rr, R, squares, middle = shard
    width = Q.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        q = (Q - middle).astype(np.float32)
        size = np.einsum("ij,ij->i", q, q, dtype=float)
        # 32 bits: of the sizes from the middle; 64 bits: of the whole sizes. Each is more than the sums of rounding errors.
        eps, fine = 4 * (width + 8) * float(np.finfo(np.float32).eps), 8 * (width + 8) * np.finfo(float).eps
        above = (limit * (1 + 1e-12)) ** 2 - size * (1 - eps) + fine * (qq + rr.max())
        below = (squares * (1 - eps)).astype(np.float32)
        above = above + np.abs(above) * 1e-6 + eps * 1e-6 * size + 1e-30  # and of these numbers themselves
        if not (np.isfinite(size).all() and np.isfinite(squares).all()) or max(size.max(), squares.max()) > 1e30:
            return _candidates(Q, qq, shard[2], rr, limit, len(rr))
        product = q @ R
        product += below
        place = np.flatnonzero(product <= np.nextafter(above.astype(np.float32), np.float32(np.inf))[:, None])
    return place // R.shape[1], place % R.shape[1]


def _gaps(low, high, lows, highs):
    """Squared least distance of a box (or point) from each of many boxes."""
    gap = np.maximum(np.maximum(lows - high, low - highs), 0)
    return np.einsum("ij,ij->i", gap, gap)


def _nearest(folder: str, shards: list, k: int, decimals: int):
    half = 10.0 ** -decimals
    names = [name for name, _, _ in shards]

    def of_block(Q: np.ndarray, odd: bool, lows: np.ndarray, highs: np.ndarray, held: _Shards) -> dict:
        """The k best of every query, by query, rounded distance and reference id."""
        qq, n = np.einsum("ij,ij->i", Q, Q), len(Q)
        best = {c: np.zeros(0, t) for c, t in (("q", np.int64), ("near", float), ("rid", np.int64), ("dist", float), ("label", float))}
        worst = np.full(n, np.inf)  # the last of k, infinite if there are fewer
        parts = [np.arange(n)] if odd else _parts(Q, PART_QUERIES)
        if odd:
            least, order = np.zeros((1, len(names))), range(len(names))
        else:
            least = np.stack([_gaps(Q[p].min(0), Q[p].max(0), lows, highs) for p in parts])
            order = np.argsort(np.mean([_gaps(m, m, lows, highs) for m in (Q[p].mean(0) for p in parts[::max(1, len(parts) // 8)])], 0), kind="stable")
        firsts = set() if odd else {int(s) for s in least.argmin(1)}  # where each part begins
        order = [*sorted(firsts), *(int(s) for s in order if int(s) not in firsts)]
        for s in order:
            limits = (np.array([worst[p].max() for p in parts]) + half) * (1 + 1e-9)
            some = [p for p, near in zip(parts, least[:, s] <= limits ** 2) if near]
            if not some:
                continue
            which = np.concatenate(some)
            if not odd and np.isfinite(worst[which]).all() and len(which) > PART_QUERIES // 8:
                gap = np.maximum(np.maximum(lows[s] - Q[which], Q[which] - highs[s]), 0)
                which = which[np.einsum("ij,ij->i", gap, gap) <= ((worst[which] + half) * (1 + 1e-9)) ** 2]
                if not len(which):
                    continue
            rid, label, R, rr, *_ = shard = held[s]
            found, step = [], max(1, PRODUCTS // len(R))
            for a in range(0, len(which), step):
                mine = which[a:a + step]
                limit = worst[mine] + half
                plain = not odd and np.isfinite(limit).all()
                i, j = _near(Q[mine], qq[mine], shard, limit) if plain else _candidates(Q[mine], qq[mine], R, rr, limit, k)
                for b in range(0, len(i), PAIRS):
                    q, r = mine[i[b:b + PAIRS]], j[b:b + PAIRS]
                    diff = Q[q] - R[r]
                    dist = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                    near = np.round(dist, decimals)
                    ok = near <= worst[q]  # also drops NaN
                    found.append(_first({"q": q[ok], "near": near[ok], "rid": rid[r[ok]], "dist": dist[ok], "label": label[r[ok]]}, k)[0])
            if sum(len(x["q"]) for x in found):
                touched = np.zeros(n, bool)
                for x in found:
                    touched[x["q"]] = True
                again = touched[best["q"]]  # the others stay as they are
                new, place = _first({c: np.concatenate([best[c][again], *(x[c] for x in found)]) for c in best}, k)
                best = {c: np.concatenate([v[~again], new[c]]) for c, v in best.items()}
                last = place == k - 1
                worst[new["q"][last]] = new["near"][last]
        return best

    def search(batches):
        held = _Shards(folder, names)
        lows, highs = (np.array([np.frombuffer(s[c], "<f8") for s in shards]) for c in (1, 2))
        for part, every in _blocks(batches, "qv"):
            leaf = part.column("leaf").to_numpy()
            cuts = np.flatnonzero(np.diff(leaf < 0)) + 1
            for of in np.split(np.arange(len(leaf)), cuts):  # rows come sorted by leaf, those with odd entries first
                for a in range(0, len(of), BLOCK_QUERIES):
                    rows = of[a:a + BLOCK_QUERIES]
                    best = of_block(every[rows], leaf[rows[0]] < 0, lows, highs, held) if names else {"q": []}
                    qid = part.column("qid").to_numpy()[rows]
                    for s in range(0, len(best["q"]), 1 << 16):
                        x = {c: v[s:s + (1 << 16)] for c, v in best.items()}
                        yield pa.record_batch([pa.array(qid[x["q"]]), pa.array(x["rid"]), pa.array(x["dist"]), pa.array(x["label"], from_pandas=True), pa.array(x["near"])],
                                              names=["qid", "rid", "dist", "label", "near"])
    return search


def _first(rows: dict, k: int) -> tuple[dict, np.ndarray]:
    """The k first rows of every query by (rounded distance, reference id), and their places."""
    order = np.lexsort((rows["rid"], rows["near"], rows["q"]))
    q = rows["q"][order]
    start = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, int)
    place = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    keep = place < k
    return {c: v[order[keep]] for c, v in rows.items()}, place[keep]


def knn_join(queries: DataFrame, refs: DataFrame, k: int = 10, q_id: str = "id", r_id: str = "id",
             vec: str = "features", label: str | None = None, block_rows: int = 2048,
             order_decimals: int = 9) -> DataFrame:
    """Exact k nearest references (Euclidean) for every query row.

    Returns ``(qid, rid, rank, dist[, label])``; ties are broken by reference id
    (distances rounded to ``order_decimals`` for the ordering only). A row whose
    vector is null or has a null or NaN entry is near to none. ``block_rows``:
    references in a shard at most. The references are written when called.
    """
    spark = queries.sparkSession
    lab = F.col(label).cast("double") if label else F.lit(None).cast("double")
    folder = f"{_tables(spark)}/{uuid.uuid4().hex}"
    r = refs.select(F.col(r_id).cast("long").alias("rid"), F.col(vec).cast("array<double>").alias("rv"), lab.alias("label")).where("rv is not null")
    n = r.count()
    some = r.select("rv") if n <= TREE_ROWS else r.select("rv").sample(False, TREE_ROWS / n, 42)
    vectors = [x for (x,) in some.collect()]  # for places only: about TREE_ROWS
    if len({len(x) for x in vectors}) > 1:
        raise ValueError(f"vectors of {min(map(len, vectors))} to {max(map(len, vectors))} entries")
    width = len(vectors[0]) if vectors else len(r.first().rv) if n else 0
    held = np.array(vectors, float).reshape(len(vectors), width)
    held = held[np.isfinite(held).all(1)]
    nodes = _median_tree(held, max(1, -(-len(held) // TREE_LEAVES), len(held) * block_rows // max(2 * n, 1)))
    place = "leaf int"
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    routed = r.mapInArrow(_placed(nodes, "rv", width), f"rid long, rv array<double>, label double, {place}").repartition(tasks, "leaf").sortWithinPartitions("leaf")
    # A row a shard, of the size of two vectors.
    shards = [tuple(x) for x in routed.mapInArrow(_write_shards(folder, block_rows), "name string, low binary, high binary").collect()]
    q = queries.select(F.col(q_id).cast("long").alias("qid"), F.col(vec).cast("array<double>").alias("qv")).where("qv is not null")
    if shards:
        q = q.mapInArrow(_placed(nodes, "qv", width), f"qid long, qv array<double>, {place}")
    else:
        q = q.withColumn("leaf", F.lit(0))
    # Near leaves lie in one task; rows of one leaf may be dealt to several.
    spread = q.repartitionByRange(4 * tasks, "leaf", F.xxhash64("qid")).sortWithinPartitions("leaf")
    cand = spread.mapInArrow(_nearest(folder, shards, k, order_decimals), CAND_SCHEMA)
    # A query id that comes more than once has its rows' neighbours together.
    w = Window.partitionBy("qid").orderBy("near", "rid")
    ranked = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    cols = ["qid", "rid", "rank", "dist"] + (["label"] if label else [])
    return ranked.select(*cols)


def knn_regress(queries: DataFrame, refs: DataFrame, k: int = 10, q_id: str = "id", r_id: str = "id",
                vec: str = "features", label: str = "label", **kw) -> DataFrame:
    """M3: mean target of the k nearest references."""
    nn = knn_join(queries, refs, k, q_id, r_id, vec, label, **kw)
    return nn.groupBy("qid").agg(F.avg("label").alias("prediction"), F.count(F.lit(1)).alias("n_neighbors"))

