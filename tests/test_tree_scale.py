"""Trees on many rows: what a task holds, and how many passes a forest takes when no task holds all rows."""

import tracemalloc

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from leasekit.operators import trees as T

NAMES = ["size", "age", *(f"low_card__state_{s}" for s in "abcd"), "rooms"]


def table(spark, n=700):
    draw = np.random.default_rng(21)
    state = draw.integers(0, 5, n)
    x = np.column_stack([draw.standard_normal(n).round(2), draw.integers(0, 9, n), *((state == k).astype(float) for k in range(4)), draw.integers(0, 4, n)])
    y = 30 + 8 * x[:, 0] - 5 * x[:, 1] * x[:, 3] + 2 * x[:, 6] + draw.standard_normal(n).round(2)
    made = spark.createDataFrame([(k, [float(v) for v in r], float(t)) for k, (r, t) in enumerate(zip(x, y))], "id long, x array<double>, label double").repartition(3)
    return made.select("id", "label", array_to_vector("x").alias("features"))


def trees(ensembles):
    return [[tuple(bytes(v) for v in r[2:]) for r in e.trees.orderBy("tree").collect()] for e in ensembles]


SPECS = [T.Trees("forest", 5, depth=None, least_rows=2), T.Trees("extra", 5, depth=None, least_rows=2), T.Trees("extra", 3, depth=6, columns_share=0.5, skip_fold=0),
         T.Trees("boost", 4, 0.3, depth=4, rows_share=0.7, columns_share=0.7, l2=1.0), T.Trees("boost", 3, 0.3, depth=None, leaves=9, least_rows=5)]


def test_columns_one_by_one_and_parts_of_levels_give_the_same_trees(spark, monkeypatch):
    rows = table(spark)
    fold = rows.id % 3
    whole = trees(T.fit_all(SPECS, rows, NAMES, fold=fold))
    monkeypatch.setattr(T, "FEW_ROWS", 8)
    monkeypatch.setattr(T, "FLAT_ENTRIES", 64)
    assert trees(T.fit_all(SPECS, rows, NAMES, fold=fold)) == whole
    monkeypatch.setattr(T, "PASS_BYTES", 100_000)  # a level of a tree takes several passes
    assert trees(T.fit_all(SPECS[1:4], rows, NAMES, fold=fold, local_bytes=0)) == whole[1:4]


def test_values_of_a_one_hot_group_follow_from_its_byte():
    lay = T.Layout([[0], [1, 2, 3], [4]], [np.ones(1, np.float32), np.zeros(0, np.float32), np.ones(1, np.float32)], 5, 1.0, 0.0, 4)
    x = np.array([[5, 0, 1, 0, 7], [6, 0, 0, 0, 8], [7, 1, 0, 0, 9], [8, 0, 0, 1, 1]], np.float32)
    part = {"n": 4, "codes": lay.codes(x).tobytes(), "x": x.T[lay.single].tobytes(), "y": np.zeros(4).tobytes(), "ids": np.arange(4).tobytes(), "folds": np.zeros(4, "<i4").tobytes()}
    rows = T.Rows(lay, [part])
    assert rows.x.shape == (2, 4)
    assert (rows.values(lay, np.arange(5), np.arange(4)) == x.T).all()
    assert rows.value(lay, np.array([4, 2, 1, 3]), np.arange(4)).tolist() == [7, 0, 1, 1]


def test_all_trees_of_a_forest_share_passes(spark, monkeypatch):
    calls, one = [], T._pass
    monkeypatch.setattr(T, "_pass", lambda *a: calls.append(1) or one(*a))
    few = table(spark, 300).selectExpr("id", "label", "features")
    T.fit_all([T.Trees("forest", 12, depth=3), T.Trees("extra", 12, depth=3)], few, NAMES, local_bytes=0)
    assert len(calls) <= 4  # a level each, not a level of each tree


def test_equal_rows_of_features_are_worked_on_once(spark):
    same = table(spark, 600).selectExpr("id", "label", "features")
    seven = spark.range(700).selectExpr("id", "cast(id % 7 * 3 + id % 11 as double) as label", "array(cast(id % 7 as double)) as x")
    seven = seven.select("id", "label", array_to_vector("x").alias("features"))
    for rows in (same, seven):
        specs = [T.Trees("forest", 4, depth=None, least_rows=2), T.Trees("extra", 4, depth=None, least_rows=2)]
        assert trees(T.fit_all(specs, rows, local_bytes=0)) == trees(T.fit_all(specs, rows))
    x = np.tile(np.array([[1, 2], [3, 4]], np.float32), (300, 1))
    one, which = T.different_rows(x)
    assert len(one) == 2 and (x[one][which] == x).all()


@pytest.mark.parametrize("kind", ["forest", "extra", "boost"])
def test_a_local_tree_needs_few_numbers_a_row(kind):
    n, width = 250_000, 24
    draw = np.random.default_rng(5)
    lay = T.Layout([[k] for k in range(width)], [np.sort(draw.standard_normal(200)).astype(np.float32) for _ in range(width)], width, 2.0 ** 20, 0.0, n)
    rows = object.__new__(T.Rows)
    rows.codes = draw.integers(0, 201, (width, n)).astype(np.uint8)
    rows.x = draw.standard_normal((width, n)).astype(np.float32) if kind == "extra" else None
    rows.y, rows.ids, rows.folds = draw.standard_normal(n), np.arange(n), np.zeros(n, np.int32)
    tracemalloc.start()
    T.local_tree(T.Trees(kind, depth=3, rows_share=1.0), 0, lay, rows, np.zeros(n))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * 8 * 24 + (40 << 20)  # at most 24 numbers a row; a grid (row x column) and its copies were 100


def test_last_level_takes_no_pass_of_its_own_and_rows_alike_share_a_prediction(spark, monkeypatch):
    calls, one = [], T._pass
    monkeypatch.setattr(T, "_pass", lambda *a: calls.append(1) or one(*a))
    rows = spark.range(900).selectExpr("id", "cast(id * 37 % 101 as double) as label", "array(cast(id % 3 = 0 as double)) as x")
    rows = rows.select("id", "label", array_to_vector("x").alias("features"))
    monkeypatch.setattr(T, "WRITE_EVERY", 2)
    for rows, names in ((rows, None), (table(spark, 600).selectExpr("id", "label", "features"), NAMES)):
        for spec in (T.Trees("boost", 5, 0.3, depth=1, l2=3.0), T.Trees("boost", 5, 0.3, depth=3, rows_share=0.7, columns_share=0.7)):
            calls.clear()
            assert trees(T.fit_all([spec], rows, names, local_bytes=0)) == trees(T.fit_all([spec], rows, names))
            assert len(calls) <= 5 * spec.depth  # before: a pass more for each tree
    codes = np.array([[0, 1, 0, 1] * 300, [2, 2, 2, 200] * 300], np.uint8)
    first, which = T.same_bytes(codes)
    assert len(first) == 3 and (codes[:, first][:, which] == codes).all()
    assert T.same_bytes(np.arange(300, dtype=np.uint64).view(np.uint8).reshape(300, 8).T) is None


def test_tasks_that_share_the_columns_of_boosted_trees_make_the_same_trees(spark, monkeypatch):
    rows, calls, one = table(spark), [], T._fit_shared
    fold = rows.id % 3
    specs = [T.Trees("boost", 4, 0.3, depth=4, rows_share=0.7, columns_share=0.7, l2=1.0, least_gain=0.01), T.Trees("boost", 4, 0.3, depth=None, leaves=9, least_rows=5, skip_fold=1),
             T.Trees("forest", 3, depth=4)]
    monkeypatch.setattr(T, "_fit_shared", lambda *a: calls.append(sorted(a[0])) or one(*a))
    alone = trees(T.fit_all(specs, rows, NAMES, fold=fold))
    assert not calls  # few rows
    monkeypatch.setattr(T, "SHARED_ENTRIES", 0)
    assert trees(T.fit_all(specs, rows, NAMES, fold=fold)) == alone
    assert calls == [[0, 1]]
    many = [T.Trees("boost", 1, depth=2)] * 3  # four cores are better used by a model each
    assert T._shared_by(spark, many, T.Layout([[0]], [np.zeros(0, np.float32)], 1, 1.0, 0.0, 9)) == 0


def test_a_boosted_tree_that_tasks_share_adds_up_few_rows_and_columns(monkeypatch):
    draw, n, width, ranks = np.random.default_rng(8), 6000, 12, 4
    lay = T.Layout([[k] for k in range(width)], [np.sort(draw.standard_normal(40)).astype(np.float32) for _ in range(width)], width, 2.0 ** 20, 0.0, n)
    rows = object.__new__(T.Rows)
    rows.codes, rows.x = draw.integers(0, 41, (width, n)).astype(np.uint8), None
    rows.y, rows.ids, rows.folds = draw.standard_normal(n), np.arange(n), np.zeros(n, np.int32)
    spec, told = T.Trees("boost", depth=4, l2=1.0), []
    _, whole, at = T.local_tree(spec, 0, lay, rows, np.zeros(n))
    seen, count = [], np.bincount
    # The tasks one after the other: a level is told again to those that come later.
    for level in range(spec.depth):
        cuts = []
        for rank in range(ranks):
            met = iter(told)

            def meet(found):
                for best in met:
                    return best
                cuts.append(found)
                raise StopIteration

            try:
                T.shared_tree(spec, 0, lay, rows, np.zeros(n), rank, ranks, meet)
            except StopIteration:
                pass
        told.append(T._meet(cuts[0], lambda _, cuts=cuts: [np.stack([c.gain, c.feature, c.cut]).tobytes() for c in cuts]))
    monkeypatch.setattr(np, "bincount", lambda x, *a, **k: seen.append(len(x)) or count(x, *a, **k))
    met, margin = iter(told), np.zeros(n)
    made = T.shared_tree(spec, 0, lay, rows, margin, 1, ranks, lambda _: next(met))
    assert all((made[c] == whole[c]).all() for c in whole)
    assert np.unique(margin).size == (whole["left"] == np.arange(len(whole["left"]))).sum()
    assert sum(seen) <= 2 * (width // ranks) * n * (1 + (spec.depth - 1) / 2)  # own columns, at most half of the rows below the root


def test_tasks_that_share_the_rows_of_boosted_trees_make_the_same_trees(spark, monkeypatch):
    rows, calls, one = table(spark), [], T._fit_shared
    fold = rows.id % 3
    specs = [T.Trees("boost", 4, 0.3, depth=4, rows_share=0.7, columns_share=0.7, l2=1.0, least_gain=0.01), T.Trees("boost", 4, 0.3, depth=None, leaves=9, least_rows=5, skip_fold=1),
             T.Trees("forest", 3, depth=4), T.Trees("boost", 2, 0.3, depth=0)]
    alone = trees(T.fit_all(specs, rows, NAMES, fold=fold))
    monkeypatch.setattr(T, "SHARED_ENTRIES", 0)
    monkeypatch.setattr(T, "MEET_BYTES", 1)  # a few nodes at a time
    monkeypatch.setattr(T, "_fit_shared", lambda *a, **k: calls.append((sorted(a[0]), k)) or one(*a, **k))
    monkeypatch.setattr(T, "_fit_distributed", lambda *a, distributed=T._fit_distributed: calls.append(len(a[0])) or distributed(*a))
    size = 700 * (4 + 20)  # more than one task may hold: before, a pass over all rows for each level of each tree
    assert trees(T.fit_all(specs, rows, NAMES, fold=fold, local_bytes=size // 3)) == alone
    assert calls == [([0, 1, 3], {"by_rows": True}), 1]
    calls.clear()
    assert trees(T.fit_all(specs, rows, NAMES, fold=fold, local_bytes=size // 8)) == alone  # nor its share
    assert calls == [4]
    chains = {0: T.Trees("boost", depth=8)}
    lay = T.Layout([[k] for k in range(50)], [np.arange(200, dtype=np.float32)] * 50, 50, 1.0, 0.0, 10_000_000)
    assert T._by_rows(chains, lay)
    lay.rows = 10_000
    assert not T._by_rows(chains, lay)  # sums would be more than rows


def test_columns_of_few_bins_share_a_byte():
    draw, n = np.random.default_rng(3), 500
    sizes = [2] * 11 + [200, 7, 30, 1, 4]
    lay = T.Layout([[k] for k in range(16)], [np.arange(s - 1, dtype=np.float32) for s in sizes], 16, 1.0, 0.0, n)
    codes = np.stack([draw.integers(0, s, n) for s in sizes]).astype(np.uint8)
    part = {"n": n, "codes": codes.tobytes(), "x": b"", "y": np.zeros(n).tobytes(), "ids": np.arange(n).tobytes(), "folds": b""}
    import pyarrow as pa

    packs = T.Packs(lay)
    rows = packs.rows(iter([pa.record_batch([pa.array([part[c]]) for c in T._BLOCK], names=T._BLOCK)]))
    assert len(rows.codes) == 4 and len(rows.y) == n and not len(rows.folds)
    which, node, g = np.arange(0, n, 2), np.arange(n // 2) % 3, draw.integers(-50, 50, n // 2).astype(float)
    found = packs.sums(rows, [0, 5, 11, 12, 15], which, node, 3, g)
    assert sorted(found) == [0, 5, 11, 12, 15]
    for c, sums in found.items():
        assert (sums == T.histogram(codes[c][which], node, 3, sizes[c], g, None)[[0, 2]]).all()
    for c in (k for k, s in enumerate(sizes) if s > 1):
        assert (packs.codes(rows, c, which) == codes[c][which]).all()


def test_blocks_are_not_copied_for_every_task_and_large_ensembles_stay_in_files(spark, monkeypatch):
    rows = table(spark)
    lay = T.layout(rows, rows.label, "features", NAMES)
    made = T.materialize(T.blocks(rows, rows.label, "features", lay, "id", None, True))
    for spec in (T.Trees("extra", 12, depth=3), T.Trees("forest", 12, depth=3)):
        plan = T._fit_groups({0: spec}, lay, made)._jdf.queryExecution().executedPlan().toString()
        assert "codes" not in plan and "Generate" not in plan, plan  # before: shuffled once for each task
    specs = [T.Trees("forest", 7, depth=4), T.Trees("extra", 12, depth=None, least_rows=2)]
    models = T.fit_all(specs, rows, NAMES)
    scored = lambda: [[r.prediction for r in m.transform(rows).orderBy("id").collect()] for m in models]
    whole = scored()
    monkeypatch.setattr(T, "SENT_BYTES", 1)
    monkeypatch.setattr(T, "HELD_BYTES", 2000)
    monkeypatch.setattr(T.Ensemble, "_some", None)  # no tree comes to the driver
    assert scored() == whole
    persisted = T.Ensemble(models[1].spec, models[1].trees.repartition(2), models[1].base, models[1].width)
    again = [r.prediction for r in persisted.transform(rows).orderBy("id").collect()]
    assert np.abs(np.subtract(again, whole[1])).max() < 1e-9  # the same trees in another order
