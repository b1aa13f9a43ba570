"""Operators 11 to 13: whitening against numpy's eigenvectors, language identification by held-out accuracy, search against
brute force and DuckDB; awkward rows for each."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from leasekit.llm import language_id, lexical_search, whitening
from leasekit.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.fixtures import CLASHING, documents, empty

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ 11
def brute_whitening(vectors, k):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    z = (n * x - total) / n
    values, directions = np.linalg.eigh(z.T @ z / n)
    values, directions = values[::-1][:k], directions[:, ::-1][:, :k]
    return ((n * x - total) ** 2).sum(1), np.abs(z @ directions / np.sqrt(values)), values / (z * z).sum(1).mean()


def test_whitening_equals_numpy(spark):
    out = QUERIES["op11_embedding_whitening"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    given = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    deviation, whitened, explained = brute_whitening(given["embedding"].tolist(), 8)
    assert len(out) == 8 * len(given) and out["n"].eq(len(given)).all()
    assert (out["deviation"].to_numpy().reshape(-1, 8) == deviation[:, None]).all()
    assert np.abs(np.abs(out["whitened"].to_numpy().reshape(-1, 8)) - whitened).max() < 1e-9
    assert np.abs(out["explained"].to_numpy()[:8] / explained - 1).max() < 1e-10
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-10
    w = out["whitened"].to_numpy().reshape(-1, 8)
    assert np.abs(w.T @ w / len(w) - np.eye(8)).max() < 1e-10


@pytest.mark.parametrize("shape, spectrum", [
    ((500, 5), np.ones(5)), ((3, 40), np.ones(40)), ((3000, 200), 0.95 ** np.arange(200)), ((2000, 120), np.linspace(1, 0.9, 120)),
    ((400, 30), np.array([5.0] * 9 + [1.0] * 21)), ((1, 3), np.ones(3)), ((700, 60), 10.0 ** -np.arange(60))])
def test_eigenpairs(shape, spectrum):
    z = np.random.default_rng(5).standard_normal(shape) * spectrum
    covariance = z.T @ z / len(z)
    calls = []

    def product(w):
        calls.append(w.shape[1])
        return covariance @ w

    values, vectors, worst = whitening.eigenpairs(product, shape[1], 8)
    expected = np.linalg.eigvalsh(covariance)[::-1][:8]
    assert len(values) == min(8, shape[1]) and worst < 1e-12
    assert np.abs(values - expected).max() < 1e-13 * expected[0] * 10
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.linalg.norm(covariance @ vectors - vectors * values, axis=0).max() < 1e-12 * expected[0]
    assert max(calls) <= 16  # a few columns at a time: the matrix is never formed


def test_eigenpairs_of_equal_values():
    values, vectors, _ = whitening.eigenpairs(lambda w: 9.0 * w, 20, 8)
    assert np.allclose(values, 9) and np.allclose(vectors.T @ vectors, np.eye(8))


def test_whitening_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [math.sin(k), math.cos(3 * k), k / 7], "x") for k in range(20)]
    rows += [(3, [math.sin(3), math.cos(9), 3 / 7], "x"), (None, [0.5, 0.25, 1.0], "x"), (50, None, "x"), (51, [1.0, None, 2.0], "x"), (52, [nan, 1.0, 2.0], "x"),
             (53, [1.0, -inf, 2.0], "x"), (54, [1.0], "x"), (55, [], "x")]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string")
    out = whitening.whiten(given, components=8).toPandas()
    good = [[*(np.float32(e) for v in [r[1]] for e in v), *[0.0] * (3 - len(r[1]))] for r in rows if r[0] not in (50, 51, 52, 53)]
    deviation, whitened, explained = brute_whitening(good, 3)
    assert len(out) == 3 * len(good) and set(out["component"]) == {1, 2, 3}
    assert sorted(map(int, out["deviation"])) == sorted(int(d) for d in deviation for _ in range(3))
    assert np.abs(np.sort(np.abs(out["whitened"])) - np.sort(whitened.ravel())).max() < 1e-9
    assert out["vec_id"].isna().sum() == 3 and (out["vec_id"] == 3).sum() == 6


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(3)], "vec_id long, embedding array<double>")
    out = whitening.whiten(same).toPandas()
    assert len(out) == 6 and out["whitened"].isna().all() and out["identity_error"].isna().all() and out["explained"].isna().all()
    assert not out["deviation"].astype(float).any()
    line = spark.createDataFrame([(k, [float(k), 2.0 * k]) for k in range(5)], "vec_id long, embedding array<double>")
    out = whitening.whiten(line).toPandas()
    assert out.loc[out.component == 1, "whitened"].notna().all() and out.loc[out.component == 2, "whitened"].isna().all()
    assert whitening.whiten(same.where("vec_id < 0")).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [])], "vec_id long, embedding array<double>")).count() == 0


def test_whitening_large_entries(spark):
    """Exact sums and deviations beyond 64 bits, and entries that no long holds."""
    rows = [(k, [(-1.0) ** k * 3e9 + k, 1e300 * (k % 2)]) for k in range(6)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("component = 1").toPandas().sort_values("vec_id")
    x = [[math.floor(1024 * v[0]) + 100_000, (1 << 52) if v[1] else 100_000] for _, v in rows]
    total = [sum(c) for c in zip(*x)]
    assert [int(d) for d in out["deviation"]] == [sum((6 * a - t) ** 2 for a, t in zip(r, total)) for r in x]


# ------------------------------------------------------------------ 12
def test_language_held_out(spark):
    out = QUERIES["op12_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    assert sorted(out["doc_id"]) == sorted(given["doc_id"]) and out["score"].between(0, 1).all()
    both = out.merge(given, on="doc_id")
    assert (both["held_out"] == both["doc_id"].map(lambda i: crc32(str(i).encode()) % 4 == 2)).all()
    held = both[both["held_out"]]
    assert len(held) > 200 and (held["lang"] == held["lang_pred"]).mean() > 0.99
    assert abs(held["score"].mean() - (held["lang"] == held["lang_pred"]).mean()) < 0.02  # calibrated


def test_language_reads_text_only(spark):
    """Other langs and sources on the held-out rows, and other texts there, change nothing for the rest."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    held = language_id.held_out(F.col("doc_id"))
    other = given.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("y"))
    first, second = (sorted(map(tuple, language_id.identify(d).collect())) for d in (given, other))
    assert first == second


def test_language_awkward_rows(spark):
    learn = [(k, "the cat and the dog run over there with me " * 2, "en") for k in range(40)] + [(100 + k, "der hund und die katze laufen über straße " * 2, "de") for k in range(40)]
    odd = [(None, "the dog", "en"), (200, None, "en"), (201, "", "de"), (202, "12 34 !! \n", "en"), (203, "der hund und die katze", None), (5, "the cat and the dog", "en"), (5, "the cat and the dog", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", "e") for i, t, lang in learn + odd], "doc_id long, text string, lang string, held_out string, score string")
    out = language_id.identify(docs).collect()
    assert len(out) == 87
    by_id = {r.doc_id: r for r in out}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (200, 201, 202))
    assert by_id[203].lang_pred == "de" and by_id[None].lang_pred == "en" and by_id[None].held_out is False
    assert sum(r.doc_id == 5 for r in out) == 3
    assert language_id.identify(empty(spark)).count() == 0
    nothing = language_id.identify(documents(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    one = language_id.identify(documents(spark).withColumn("lang", F.lit("q"))).collect()
    assert {r.lang_pred for r in one} == {"q", "und"}


def test_language_features(monkeypatch):
    text = "Hello wörld, 12 the QUICK  brown İstanbul fox. ÉCOLE 漢字!" * 30
    place, count = language_id.features(text)
    spaced = "\0" + re.sub("\0+", "\0", "".join(c if c.isalpha() else "\0" for c in text.lower()))
    grams = Counter(spaced[k:k + n] for n in (1, 2, 3) for k in range(len(spaced) - n + 1))
    grams.pop("\0")
    assert count.sum() == sum(grams.values()) and len(place) == len(grams)  # no two of these few collide
    for size in (7, 33, 1000):  # blocks of any size give the same
        monkeypatch.setattr(language_id, "BLOCK", size)
        assert all((a == b).all() for a, b in zip(language_id.features(text), (place, count)))


def test_follow_leader_is_sparse_and_right():
    """Two informative features among noise: weights of the noise are exactly 0 under the L1 penalty, and FTRL's step equals
    its closed form after one example."""
    draw = np.random.default_rng(3)
    y = draw.integers(0, 2, 400)
    rows = [(np.array([label, *(2 + draw.integers(0, 50, 2))]), np.array([0.8, 0.05, 0.05])) for label in y]
    w, b = language_id.follow_leader(rows, y, 2, buckets=60, l1=0.5)
    assert w[0, 0] > 0.5 > -0.5 > w[0, 1] and w[1, 1] > 0.5 and not w[2:].any()
    w, b = language_id.follow_leader([(np.array([0]), np.array([1.0]))], np.array([0]), 2, buckets=1, epochs=1, alpha=0.5, beta=1.0, l1=0.1, l2=0.3)
    assert np.allclose(w[0], [(0.5 - 0.1) / ((1 + 0.5) / 0.5 + 0.3), -(0.5 - 0.1) / ((1 + 0.5) / 0.5 + 0.3)]) and np.allclose(b, [0.5 / 3.3, -0.5 / 3.3])


def test_temperature():
    draw = np.random.default_rng(1)
    sums = draw.standard_normal((4000, 3)) * 2
    y = np.array([draw.choice(3, p=language_id.softmax(s)) for s in sums])
    assert abs(language_id.fit_temperature(sums * 4, y) - 4) < 0.5
    assert language_id.fit_temperature(sums[:0], y[:0]) == 1.0


# ------------------------------------------------------------------ 13
def brute_search(docs, items, top=10):
    pattern = re.compile(lexical_search.TERM_PATTERN)
    fold = lambda t: pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    terms = [(i, Counter(fold(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in terms if c]
    n, total, df = len(held), sum(s for _, _, s in held), Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, t in {(i, t) for i, t in items}:
        asked.setdefault(i, Counter()).update(fold(t))
    out = []
    for item, q in asked.items():
        scores = []
        for i, c, size in held:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, k in q.items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        scores.sort(key=lambda x: x if not x[1] else (x[0], True, 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scores[:top])]
    return sorted(out, key=str)


def test_search_equals_duckdb(spark):
    got = sorted(map(tuple, QUERIES["op13_lexical_search"](spark, SF).select("item_id", "rank", "doc_id", "score").collect()))
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert got == sorted(db.execute(ORACLE_SQL["op13_lexical_search"]).fetchall())


@pytest.mark.parametrize("leaf, tree, terms", [(2, 40, 1 << 20), (256, 1 << 20, 12)])
def test_search_equals_brute_force(spark, monkeypatch, leaf, tree, terms):
    """Small leaves and trees prune; small blocks of items make several passes."""
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", terms)
    monkeypatch.setattr(lexical_search, "TREE", tree)
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    draw = random.Random(11)
    words = ["Alpha", "beta", "GAMMA", "délta", "ÉPSILON", "zeta1", "漢字", "x", "the", "of"]
    docs = [(k, " ".join(draw.choices(words, k=draw.randrange(0, 30)))) for k in range(150)]
    docs += [(200 + k, "alpha, beta!gamma\x7fdélta") for k in range(15)] + [(7, docs[7][1]), (None, "alpha beta"), (301, None), (302, ""), (303, " \n--"), (304, "beta " * 5000)]
    items = [(1, "alpha BETA beta"), (1, "alpha BETA beta"), (2, "délta épsilon ÉPSILON"), (3, None), (4, ""), (5, "unknown words"), (None, "x x x 漢字"), (6, "the of"), (6, "alpha")]
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    got = lexical_search.search(spark.createDataFrame([(*d, *["x"] * len(CLASHING)) for d in docs], f"doc_id long, text string, {extra}").repartition(3), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items)


def test_search_of_nothing(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(empty(spark), items).count() == 0
    assert lexical_search.search(documents(spark), items.where("item_id < 0")).count() == 0


def test_search_long_text(spark, monkeypatch):
    """A text over several pieces counts as one."""
    monkeypatch.setattr(lexical_search, "BATCH_BYTES", 64)
    docs, items = [(1, "alpha beta-gamma " * 200), (2, "beta"), (3, "alpha" * 100)], [(1, "beta alpha"), (2, "alpha" * 100)]
    data = np.frombuffer((docs[0][1]).encode(), np.uint8)
    assert b"".join(p.tobytes() for p in lexical_search._pieces(data)).decode() == docs[0][1]
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items)


def test_ball_tree_bounds_and_pruning():
    """No row scores over its nodes' bounds, and where rows lie in clusters most nodes are never seen."""
    draw = np.random.default_rng(2)
    groups = [np.sort(draw.choice(400, 12, False)) for _ in range(40)]
    place = np.concatenate([groups[k % 40] for k in range(2000)])
    value = draw.integers(900_000, 1_000_000, len(place))
    first = np.arange(2001) * 12
    tree = lexical_search.ball_tree(first, place, value, 400, leaf=16)
    dense = np.zeros((2000, 400), np.int64)
    dense[np.repeat(np.arange(2000), 12), place] = value
    for g in range(5):
        q = np.zeros(400, np.int64)
        q[groups[g]] = draw.integers(1, 9000, 12)
        scores, norm = dense @ q, math.sqrt(float(q @ q))
        for node in range(len(tree.begin)):
            assert scores[tree.order[tree.begin[node]:tree.end[node]]].max() <= tree.bound(node, q, norm)
        kept = []

        def offer(rows, found):
            kept.extend(zip(found.tolist(), rows.tolist()))
            kept.sort(reverse=True)
            del kept[10:]
            return kept[-1][0] if len(kept) == 10 else 1

        seen = lexical_search.best_rows(tree, q, 1, offer)
        assert [s for s, _ in kept] == sorted(scores.tolist(), reverse=True)[:10]
        assert seen < len(tree.begin) / 4
