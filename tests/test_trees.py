"""Tree ensembles against brute-force split search, and both ways to run against each other."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leasekit.operators import trees as T


def table(spark, x, y):
    rows = [(k, [float(v) for v in r], float(t)) for k, (r, t) in enumerate(zip(x, y))]
    made = spark.createDataFrame(rows, "id long, x array<double>, label double").repartition(3)
    return made.select("id", "label", array_to_vector("x").alias("features"))


@pytest.fixture(scope="module")
def sample():
    draw = np.random.default_rng(8)
    x = np.column_stack([draw.integers(0, 30, 400), draw.standard_normal(400).round(1), draw.integers(0, 2, 400), np.full(400, 3.0),
                         draw.exponential(2, 400).round(1)]).astype(np.float32)
    y = 40 + 3 * x[:, 0] - 11 * x[:, 1] * (x[:, 2] > 0) + draw.standard_normal(400).round(3) * 5
    return x, y


def brute_cut(x, g, h, rows, spec, columns):
    """Best (gain, feature, threshold) over every feature and value, the first of equals."""
    soft = lambda v: math.copysign(max(abs(v) - spec.l1, 0), v)
    score = lambda i: soft(g[i].sum()) ** 2 / (h[i].sum() + spec.l2)
    best = (spec.least_gain + 1e-9, None, None)
    for f in columns:
        for v in np.unique(x[rows, f])[:-1]:
            left, right = rows[x[rows, f] <= v], rows[x[rows, f] > v]
            if min(len(left), len(right)) >= max(spec.least_rows, 1):
                gain = score(left) + score(right) - score(rows)
                if gain > best[0] + 1e-7:
                    best = (gain, f, v)
    return best


def brute_tree(x, g, h, rows, spec, columns):
    """Level-wise or leaf-wise tree as a function from a row to its leaf's value."""
    value = lambda i: -math.copysign(max(abs(g[i].sum()) - spec.l1, 0), g[i].sum()) / (h[i].sum() + spec.l2)
    root = {"rows": rows, "level": 0}
    leaves = [root]
    while spec.leaves is None or len(leaves) < spec.leaves:
        for leaf in leaves:
            if "cut" not in leaf:
                deep = spec.depth is not None and leaf["level"] >= spec.depth
                leaf["cut"] = (0, None, None) if deep or len(leaf["rows"]) < spec.least_to_split else brute_cut(x, g, h, leaf["rows"], spec, columns)
        able = [leaf for leaf in leaves if leaf["cut"][1] is not None]
        if not able:
            break
        leaf = max(able, key=lambda q: q["cut"][0])
        _, f, v = leaf["cut"]
        leaf["kids"] = [{"rows": leaf["rows"][m], "level": leaf["level"] + 1} for m in (x[leaf["rows"], f] <= v, x[leaf["rows"], f] > v)]
        leaves = [q for q in leaves if q is not leaf] + leaf["kids"]

    def predict(row):
        node = root
        while "kids" in node:
            node = node["kids"][0 if row[node["cut"][1]] <= node["cut"][2] else 1]
        return value(node["rows"])

    return lambda rows: np.array([predict(r) for r in rows])


def hashes(spark, n):
    return np.array([r[0] for r in spark.range(n).select(F.xxhash64("id")).orderBy("id").collect()])


def brute_ensemble(spark, x, y, spec):
    ids, n = hashes(spark, len(y)), len(y)
    out, base = np.zeros(n), y.mean()
    for t in range(spec.trees):
        w = T.row_weights(spec, t, ids)
        w = np.ones(n) if w is None else w
        columns = [f for f in range(x.shape[1]) if T.tree_columns(spec, t, x.shape[1])[f]]
        g = (base + out - y) if spec.kind == "boost" else base - y
        tree = brute_tree(x, g * w, w, np.flatnonzero(w > 0), spec, columns)
        out = out + tree(x) * (spec.rate if spec.kind == "boost" else 1 / spec.trees)
    return base + out


SPECS = [
    T.Trees("boost", 5, 0.3, depth=3),
    T.Trees("boost", 4, 0.3, depth=4, least_rows=5, l1=2.0, l2=1.5, least_gain=40.0),
    T.Trees("boost", 4, 0.3, depth=None, leaves=7, least_rows=8),
    T.Trees("boost", 4, 0.3, depth=4, rows_share=0.7, columns_share=0.6),
    T.Trees("forest", 3, depth=None, least_rows=2),
    T.Trees("forest", 2, depth=5, least_rows=3, least_to_split=12),
]


@pytest.mark.parametrize("spec", SPECS)
def test_equals_brute_force(spark, sample, spec):
    x, y = sample
    model = spec.fit(table(spark, x, y))
    got = model.transform(table(spark, x, y)).orderBy("id").toPandas()["prediction"].to_numpy()
    assert np.abs(got - brute_ensemble(spark, x, y, spec)).max() < 1e-6


def rows_of(model):
    return [tuple(r[c] for c in ("tree", "feature", "cut", "left", "right", "value")) for r in model.trees.orderBy("tree").collect()]


def test_distributed_levels_make_the_same_trees(spark, sample, monkeypatch):
    """One group a model, or passes over blocks: equal to the byte, for all kinds, folds and row orders."""
    monkeypatch.setattr(T, "BLOCK_ROWS", 64)
    monkeypatch.setattr(T, "FOREST_BATCH", 2)
    monkeypatch.setattr(T, "WRITE_EVERY", 2)
    x, y = sample
    names = ["a", "b", "low_card__state_x", "c", "d"]
    specs = [T.Trees("boost", 3, 0.3, depth=3, rows_share=0.8, columns_share=0.8, l1=0.5), T.Trees("boost", 3, 0.3, depth=None, leaves=6, least_rows=5, skip_fold=1),
             T.Trees("forest", 2, depth=6, least_rows=2), T.Trees("extra", 3, depth=4, least_rows=2, columns_share=0.7)]
    fold = F.pmod(F.col("id"), F.lit(3))
    one = T.fit_all(specs, table(spark, x, y), names, fold=fold)
    two = T.fit_all(specs, table(spark, x, y).orderBy(F.rand(3)), names, fold=fold, local_bytes=0)
    for a, b in zip(one, two):
        assert rows_of(a) == rows_of(b)


def test_extra_trees_cuts(spark, sample):
    """A cut lies between its node's least and greatest value, is the best of those drawn, and leaves are means."""
    x, y = sample
    model = T.Trees("extra", 4, depth=None, least_rows=2).fit(table(spark, x, y))
    for r in model.trees.collect():
        f, cut, left, right, value = (np.frombuffer(r[c], t) for c, t in (("feature", "<i4"), ("cut", "<f4"), ("left", "<i4"), ("right", "<i4"), ("value", "<f8")))
        rows = {0: np.arange(len(y))}
        for node in range(len(f)):
            here = rows[node]
            assert len(here) >= 2
            if left[node] == node:
                assert abs(value[node] + y.mean() - y[here].mean()) < 1e-6
                continue
            v = x[here, f[node]]
            assert v.min() <= cut[node] < v.max()
            rows[left[node]], rows[right[node]] = here[v <= cut[node]], here[v > cut[node]]
            cuts = T.random_cuts(model.spec, r["tree"], np.array([node]), x[here].min(0)[:, None], x[here].max(0)[:, None], np.arange(5)) if node == 0 else None
            if cuts is not None:  # numbered alike while growing and in the end: the root
                gains = [((y[here] - y[here].mean()) ** 2).sum() - sum(((p - p.mean()) ** 2).sum() for p in (y[here][x[here, k] <= c], y[here][x[here, k] > c])) if c == c else -1 for k, c in enumerate(cuts[:, 0])]
                assert f[0] == int(np.argmax(gains)) and cut[0] == cuts[f[0], 0]


def test_one_hot_group_equals_single_columns(spark):
    """Columns of a one-hot group share a byte; the trees are those of separate columns."""
    draw = np.random.default_rng(4)
    level = draw.integers(0, 5, 300)
    x = np.column_stack([draw.standard_normal(300).round(1), *(level == k for k in range(1, 5))]).astype(np.float32)
    y = np.array([3.0, -5, 8, 1, 0])[level] + x[:, 0] + draw.standard_normal(300).round(2)
    data = table(spark, x, y)
    spec = T.Trees("boost", 6, 0.4, depth=3, columns_share=0.8)
    grouped = T.fit_all([spec], data, ["n", *(f"low_card__state_{k}" for k in range(4))])[0]
    single = T.fit_all([spec], data, [str(k) for k in range(5)])[0]
    a, b = (m.transform(data).orderBy("id").toPandas()["prediction"] for m in (grouped, single))
    assert np.abs(a - b).max() < 1e-9
    assert len(T.one_hot_groups(["n", *(f"low_card__state_{k}" for k in range(4))], 5)) == 2


def test_awkward_rows(spark, sample):
    x, y = sample
    data = table(spark, x[:60], y[:60])
    odd = data.unionByName(data.limit(5)).unionByName(data.limit(3).withColumn("label", F.lit(None).cast("double")))
    for spec in (T.Trees("boost", 3, depth=2), T.Trees("forest", 3, depth=None), T.Trees("extra", 3, depth=None)):
        model = spec.fit(odd)
        out = model.transform(odd.withColumn("_keep", F.lit(1)))
        assert out.count() == 68 and out.where("prediction is null").count() == 0 and out.columns[-1] == "prediction"
        none = spec.fit(data.where("id < 0"))
        assert {r.prediction for r in none.transform(data).collect()} == {0.0}
        same = spec.fit(data.withColumn("label", F.lit(7.0)))
        assert all(abs(r.prediction - 7) < 1e-9 for r in same.transform(data).collect())


def test_bins_of_many_values():
    """Summaries merge: edges of a summary of summaries are near the true quantiles; few values are exact."""
    draw = np.random.default_rng(1)
    whole = draw.standard_normal(60_000).astype(np.float32)
    v, w = np.zeros(0, np.float32), np.zeros(0)
    for part in np.array_split(whole, 13):
        v, w = T.summarise(np.append(v, part), np.append(w, np.ones(len(part))))
    assert len(v) <= T.SUMMARY and abs(w.sum() - len(whole)) < 1e-3 and v[0] == whole.min() and v[-1] == whole.max()
    edges = T.bin_edges(v, w)
    assert len(edges) == T.BINS - 1
    shares = np.searchsorted(np.sort(whole), edges, "right") / len(whole)
    assert np.abs(shares - np.arange(1, T.BINS) / T.BINS).max() < 0.002
    assert T.bin_edges(np.array([1.0, 2.0, 5.0], np.float32), np.ones(3)).tolist() == [1.0, 2.0]
    assert not len(T.bin_edges(np.array([4.0], np.float32), np.ones(1)))


def test_importance_and_sent_batches(spark, sample, monkeypatch):
    x, y = sample
    data = table(spark, x, y)
    model = T.Trees("forest", 6, depth=4, least_rows=2).fit(data)
    share = model.featureImportances
    assert abs(share.sum() - 1) < 1e-9 and share.argmax() == 0 and share[3] == 0
    whole = model.transform(data).orderBy("id").toPandas()["prediction"]
    monkeypatch.setattr(T, "SENT_BYTES", 1)
    assert len(list(model.batches())) == 6
    assert np.abs(model.transform(data).orderBy("id").toPandas()["prediction"] - whole).max() < 1e-9
