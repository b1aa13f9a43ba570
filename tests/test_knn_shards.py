"""k-NN: references are files that tasks read one after another; the neighbours equal brute force over whole distances."""

import numpy as np
from pyspark.sql import functions as F


def _brute(q, r, k):
    out = []
    for i, x in q:
        near = sorted((round(float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum())), 9), j) for j, y in r)
        out += [(i, j, n + 1) for n, (_, j) in enumerate(near[:k])]
    return sorted(out)


def test_knn_equals_brute_force_with_ties_and_large_offsets(spark):
    from leasekit.operators.knn import knn_join

    rng = np.random.default_rng(3)
    for offset, width in ((0.0, 3), (1e6, 5)):
        points = rng.integers(0, 4, (400, width)) * 0.25 + offset  # few different points: many equal distances
        rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
        q, r = rows[:60], rows[60:]
        schema = "id long, features array<double>"
        for block in (17, 2048):
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many tasks: no pair may be lost
            try:
                got = knn_join(spark.createDataFrame(q, schema), spark.createDataFrame(r, schema), k=7, block_rows=block).collect()
            finally:
                spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            assert sorted((x.qid, x.rid, x["rank"]) for x in got) == _brute(q, r, 7)


def test_rows_are_not_copied_for_every_block(spark):
    from leasekit.operators.knn import knn_join

    rows = spark.range(1200).select("id", F.array(F.rand(1), F.rand(2)).alias("features"))
    plan = knn_join(rows, rows, k=3, block_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CoGroup" not in plan, plan


def test_nulls_and_infinite_entries(spark):
    from leasekit.operators.knn import knn_join

    schema = "id long, features array<double>"
    refs = spark.createDataFrame([(1, [0.0, 1.0]), (2, [None, 1.0]), (3, None), (4, [float("inf"), 0.0]), (5, [2.0, 2.0])], schema)
    got = knn_join(spark.createDataFrame([(9, [0.0, 0.0]), (8, None), (7, [float("nan"), 0.0])], schema), refs, k=2).collect()
    assert [(x.qid, x.rid) for x in got] == [(9, 1), (9, 5)]
    empty = knn_join(refs, refs.where("false"), k=2)
    assert empty.count() == 0


def test_blocks_leave_out_shards_that_are_too_far(tmp_path, monkeypatch):
    import pyarrow as pa

    from leasekit.operators import knn as K

    rng = np.random.default_rng(4)
    points = np.vstack([rng.standard_normal((4000, 6)), rng.standard_normal((40, 6)) * 9, np.full((300, 6), 0.5)]) + 1e5
    nodes = K._median_tree(points[::3], 20)
    leaf = K._leaf_of(nodes, points)
    order = np.argsort(leaf, kind="stable")
    vectors = lambda x: pa.array([list(v) for v in x], pa.list_(pa.float64()))
    batch = pa.record_batch([pa.array(order), pa.array(order * 0.5), vectors(points[order]), pa.array(leaf[order])], names=["rid", "label", "rv", "leaf"])
    shards = [tuple(v.as_py() for v in r) for b in K._write_shards(str(tmp_path), 30)(iter([batch])) for r in zip(*b.columns)]
    assert len(shards) > 100
    read, one = [], K._Shards.__getitem__
    monkeypatch.setattr(K._Shards, "__getitem__", lambda self, s: read.append(s) or one(self, s))
    asked = points[:20] + 0.01
    batch = pa.record_batch([pa.array(np.arange(20)), vectors(asked), pa.array(np.zeros(20, np.int32))], names=["qid", "qv", "leaf"])
    got = [tuple(v.as_py() for v in r) for b in K._nearest(str(tmp_path), shards, 7, 9)(iter([batch])) for r in zip(*b.select(["qid", "near", "rid"]).columns)]
    rank, found = {}, []
    for q, _, r in sorted(got):
        rank[q] = rank.get(q, 0) + 1
        found.append((q, r, rank[q]))
    assert sorted(found) == _brute(list(enumerate(asked)), list(enumerate(points)), 7)
    read.clear()
    single = batch.slice(3, 1)
    list(K._nearest(str(tmp_path), shards, 7, 9)(iter([single])))
    assert len(read) < len(shards) // 2  # before: every shard


def test_places_of_rows():
    from leasekit.operators import knn as K

    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, 3, 500), rng.standard_normal(500)]).astype(float)
    nodes = K._median_tree(x, 10)
    leaf = K._leaf_of(nodes, x)
    assert np.bincount(leaf).min() >= 5 and len(set(leaf)) == sum(n[0] < 0 for n in nodes)
    assert K._leaf_of(nodes, np.array([[np.nan, 0], [np.inf, 1], [0, 0.0]])).tolist()[:2] == [-1, -1]
    same = np.ones((50, 2))
    assert K._median_tree(same, 5) == [(-1, 0.0, -1, -1)] and [len(p) for p in K._parts(same, 20)] == [20, 20, 10]
    assert K._halves(np.array([[0.0], [1], [1], [1]])) == (0, 0.0)  # rows on both sides
    parts = K._parts(x, 30)
    assert max(map(len, parts)) <= 30 and sorted(np.concatenate(parts)) == list(range(500))
