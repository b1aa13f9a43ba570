"""Preprocessing, models, experiment runner and importance.

Linear models and the single tree are MLlib estimators; ensembles of trees are
our own (``trees``), all those of a stage fitted together. Encoders are fitted
on the training part (see ``encode``); the ridge penalty scale, the median
dummy, exact k-NN, voting/stacking assembly and the log-target wrapper are here.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasekit import presets
from leasekit.functions.hashing import bucket
from leasekit.functions.text import join_text
from leasekit.operators import encode as E
from leasekit.operators.evaluate import METRICS, compute_metrics
from leasekit.operators.features import column_roles
from leasekit.operators.ranking import exact_quantiles
from leasekit.operators.reports import aggregated_together
from leasekit.operators.trees import Trees, fit_all


def _plain(name: str) -> str:
    """A column name without dots (the assembler reads them as fields), different for different names."""
    return name.replace("%", "%25").replace(".", "%2E")


# ------------------------------------------------------------------ E11 E12 E13
@dataclass
class Matrix:
    """Assembled design matrix: rows (id, split, label, features) and the feature names."""

    data: DataFrame
    names: list[str]
    label: str = presets.TARGET
    info: dict = field(default_factory=dict)


@dataclass
class Text:
    """Fitted text block: ``vocab`` (term, df, j, v: its row of V) and the number of training documents."""

    vocab: DataFrame
    documents: int
    width: int
    columns: tuple[str, str] = ("title_clean", "body_clean")

    @property
    def names(self) -> list[str]:
        return [f"text_svd_{i}" for i in range(self.width)]

    def key(self):
        return F.md5(join_text(*self.columns))

    def scores(self, df: DataFrame) -> DataFrame:
        """``doc`` (a text's key) and its components, for different texts that have a known term."""
        import numpy as np

        from leasekit.operators import text_vectors as TV

        docs = df.select(self.key().alias("_doc"), join_text(*self.columns).alias("_text")).dropDuplicates(["_doc"])
        weights = TV.tfidf(TV.term_counts(docs, "_doc", "_text"), self.vocab, F.lit(self.documents))
        held = self.vocab.orderBy("j").select("v").collect()  # at most max_features rows
        v = np.array([r.v for r in held], float).reshape(-1, self.width)
        return TV.project(TV.sparse_rows(weights, self.vocab), v)


def fit_text(df: DataFrame, id_col: str, split: str, components: int) -> Text:
    from leasekit.operators import text_vectors as TV
    from leasekit.session import materialize

    train = df.filter(F.col(split) == "train").select(F.col(id_col).alias("_doc"), join_text("title_clean", "body_clean").alias("_text"))
    counts = materialize(TV.term_counts(train, "_doc", "_text"))
    index = materialize(TV.vocabulary_index(TV.fit_vocabulary(counts)))
    documents, terms = train.count(), index.count()
    if not terms:
        return Text(index.withColumn("v", F.array().cast("array<double>")), documents, 0)
    rows = materialize(TV.sparse_rows(TV.tfidf(counts, index, F.lit(documents)), index))
    _, v = TV.randomized_svd(rows, terms, max(1, min(components, terms - 1)))
    table = df.sparkSession.createDataFrame([(j, [float(x) for x in r]) for j, r in enumerate(v)], "j int, v array<double>")
    return Text(materialize(index.join(F.broadcast(table), "j")), documents, v.shape[1])


@dataclass
class Prep:
    """Fitted preprocessing (E11): statistics learned on the training part, applicable to any rows."""

    num: list[str]
    low: list[str]
    high: list[str]
    medians: dict
    std: dict | None
    modes: dict
    level_table: DataFrame | None
    levels: dict
    te: dict
    te_mean: float | None
    names: list[str]
    target: str = presets.TARGET
    id_col: str = "id"
    split: str = "split"
    text: Text | None = None

    #: Fields that are tables (or hold them); the others are written as one JSON document.
    TABLES = ("level_table", "te", "text")

    def save(self, path: str) -> None:
        """Every fitted statistic under ``path``: tables as Parquet, the rest as JSON."""
        from leasekit.sources.artifacts import write_json

        for name, table in self._tables().items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        plain = {f: v for f, v in self.__dict__.items() if f not in self.TABLES}
        text = None if self.text is None else {"documents": self.text.documents, "width": self.text.width, "columns": list(self.text.columns)}
        write_json(self._spark(), f"{path}/plain", {**plain, "te": list(self.te), "text": text, "has_levels": self.level_table is not None})

    def _spark(self):
        from pyspark.sql import SparkSession

        return SparkSession.getActiveSession()

    def _tables(self) -> dict[str, DataFrame]:
        held = {f"te-{i}": t for i, t in enumerate(self.te.values())}
        if self.level_table is not None:
            held["levels"] = self.level_table
        if self.text is not None:
            held["text"] = self.text.vocab
        return held

    @classmethod
    def load(cls, spark, path: str) -> Prep:
        """What :meth:`save` wrote: applies as the saved one does."""
        from leasekit.sources.artifacts import read_json

        plain = read_json(spark, f"{path}/plain")
        levels = spark.read.parquet(f"{path}/levels") if plain.pop("has_levels") else None
        te = {c: spark.read.parquet(f"{path}/te-{i}") for i, c in enumerate(plain.pop("te"))}
        text = plain.pop("text")
        if text is not None:
            text = Text(spark.read.parquet(f"{path}/text"), text["documents"], text["width"], tuple(text["columns"]))
        plain["levels"] = {c: (kept, pooled) for c, (kept, pooled) in plain["levels"].items()}
        return cls(level_table=levels, te=te, text=text, **plain)

    def columns(self, df: DataFrame, oof_train: bool = False, keep: Sequence[str] = ()) -> DataFrame:
        """Encoded feature columns (before vector assembly); ``keep`` columns pass through."""
        with_text = self.text is not None and self.text.width
        scores = self.text.scores(df) if with_text else None
        base = df.select(*([self.text.key().alias("_text_key")] if with_text else []), self.id_col, self.split, F.col(self.target).cast("double").alias(self.target), *keep,
                         *[F.col(c).cast("double").alias(c) for c in self.num], *self.low,
                         *[c for c in self.high if c not in self.low])
        base = E.apply_fill(base, self.medians, self.num)
        if self.std is not None:
            base = E.apply_standard(base, self.std, self.num)
        if self.low:
            base = E.apply_fill(base, self.modes, self.low)
            before = set(base.columns)
            base = E.apply_onehot(base, self.level_table, names=self.levels)
            ren = {c: _plain(f"low_card__{c}") for c in base.columns if c not in before}
            base = base.select(*[F.col(f"`{c}`").alias(ren.get(c, c)) for c in base.columns])
        for cat, enc in self.te.items():
            fold = "_fold" if oof_train else None
            if oof_train and fold not in base.columns:
                train_fold = bucket(F.col(self.id_col), f"{presets.SEED}|fold", presets.TE_FOLDS)
                base = base.withColumn(fold, F.when(F.col(self.split) == "train", train_fold).otherwise(-1))
            base = E.join_target_encoding(base, enc, cat, fold, self.te_mean, f"high_card__{cat}")
        base = base.drop("_fold")
        if scores is not None:
            base = base.join(scores.withColumnRenamed("doc", "_text_key"), "_text_key", "left").drop("_text_key").fillna(0.0, subset=self.text.names)
        return base

    def transform(self, df: DataFrame, oof_train: bool = False, keep: Sequence[str] = ()) -> DataFrame:
        base = self.columns(df, oof_train, keep)
        vec = VectorAssembler(inputCols=self.names, outputCol="features", handleInvalid="keep")
        return vec.transform(base).select(self.id_col, self.split, F.col(self.target).alias("label"), "features",
                                          *keep)


def fit_preprocessor(df: DataFrame, target: str = presets.TARGET, use_target_encoding: bool = True,
                     scale: bool = True, numeric: Sequence[str] | None = None,
                     low_card: Sequence[str] | None = None, split: str = "split", id_col: str = "id",
                     use_text: bool = False, text_components: int = presets.SVD_COMPONENTS) -> Prep:
    """Learn every statistic on the training part (one small job per statistic group)."""
    groups = column_roles(df, target)
    num = [c for c in (numeric if numeric is not None else groups["numeric"]) if c not in (id_col, "fold")]
    low = list(low_card if low_card is not None else groups["low_card"])
    high = list(groups["high_card"]) if use_target_encoding else []
    cast = df.select(id_col, split, target, *[F.col(c).cast("double").alias(c) for c in num], *low,
                     *[c for c in high if c not in low])
    # Modes, the target's mean/variance and the moments that give the std of the median-filled columns, each column read
    # once; the medians from range-sorted value counts.
    train = cast.filter(F.col(split) == "train")
    aggs = [[F.count(F.lit(1)).alias("_rows"), F.avg(target).alias("_ymean"), F.var_pop(target).alias("_yvar"),
             *[F.mode(c, True).alias(f"mode{i}") for i, c in enumerate(low)]]]
    place = {c: i for i, c in enumerate(num)}
    for some in aggregated_together(num):
        aggs.append([a for c in some for a in (F.count(c).alias(f"n{place[c]}"), F.avg(c).alias(f"a{place[c]}"),
                                               F.var_pop(c).alias(f"v{place[c]}"))])
    st = {k: v for row in at_once([lambda a=a: train.agg(*a).first() for a in aggs if a]) for k, v in row.asDict().items()}
    rows = st["_rows"]
    medians = {c: v[0] for c, v in exact_quantiles(train, num, [0.5]).items()}
    modes = {c: st[f"mode{i}"] for i, c in enumerate(low)}
    std = None
    if scale and num:
        std = {}
        for i, c in enumerate(num):
            n1, a1, v1, m = st[f"n{i}"], st[f"a{i}"], st[f"v{i}"], medians[c]
            if not n1:
                std[f"{c}__mean"], std[f"{c}__std"] = m, 1.0
                continue
            n0 = rows - n1
            mean = (n1 * a1 + n0 * m) / rows
            m2 = n1 * v1 + n1 * (a1 - mean) ** 2 + n0 * (m - mean) ** 2
            sd = (m2 / rows) ** 0.5
            std[f"{c}__mean"], std[f"{c}__std"] = mean, (sd if sd > 0 else 1.0)
    from leasekit.session import materialize

    level_table = materialize(E.fit_onehot(E.apply_fill(cast, modes, low), low, split)) if low else None
    levels = E.onehot_levels(level_table) if low else {}
    names = list(num)
    for c in low:
        kept, pooled = levels.get(c, ([], False))
        names += [_plain(f"low_card__{c}_{lv}") for lv in kept]
        if pooled:
            names.append(f"low_card__{c}_{presets.ONEHOT_INFREQUENT_LABEL}")
    te = {cat: materialize(E.target_encoding_table(cast, cat, target, split, id_col, st["_ymean"])) for cat in high}
    te_mean = st["_ymean"] if high else None
    names += [f"high_card__{cat}" for cat in high]
    text = fit_text(df, id_col, split, text_components) if use_text else None
    names += text.names if text is not None else []
    return Prep(num, low, high, medians, std, modes, level_table, levels, te, te_mean, names, target, id_col, split, text)


def prepare_matrix(df: DataFrame, target: str = presets.TARGET, use_target_encoding: bool = True,
                   use_text: bool = False, scale: bool = True, text_components: int = presets.SVD_COMPONENTS,
                   numeric: Sequence[str] | None = None, low_card: Sequence[str] | None = None,
                   split: str = "split", id_col: str = "id", materialize: bool = True) -> Matrix:
    """Fit every encoder on the training part once and apply it to all parts.

    Numeric: median impute (+ standardise); low-cardinality: mode impute +
    one-hot with rare levels pooled; city/state: cross-fitted target encoding
    on train rows, full-train encoding elsewhere; text: TF-IDF -> truncated SVD.
    The result is materialised so every model fit/trial reuses it (E13).
    """
    # Fit-once (E13): the feature table is materialised once with only the columns the
    # encoders read, so each statistic below scans it instead of recomputing the features.
    groups = column_roles(df, target)
    need = {id_col, split, target, *(numeric if numeric is not None else groups["numeric"]),
            *(low_card if low_card is not None else groups["low_card"]), *groups["high_card"],
            *(["title_clean", "body_clean"] if use_text else [])}
    if materialize:
        from leasekit.session import materialize as _mat

        df = _mat(df.select(*[c for c in df.columns if c in need]))
    prep = fit_preprocessor(df, target, use_target_encoding, scale, numeric, low_card, split, id_col, use_text, text_components)
    base = prep.columns(df, oof_train=True)
    names = list(prep.names)
    vec = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    data = vec.transform(base).select(id_col, split, F.col(target).alias("label"), "features")
    if materialize:
        from leasekit.session import materialize as _mat

        data = _mat(data)
    return Matrix(data, names, "label", {"prep": prep})


# ------------------------------------------------------------------ M1–M9
class MedianDummy:
    """M1: predicts the training median."""

    def __init__(self, labelCol="label", predictionCol="prediction"):
        self.labelCol, self.predictionCol = labelCol, predictionCol

    def fit(self, df: DataFrame):
        med = exact_quantiles(df.select(self.labelCol), [self.labelCol], [0.5])[self.labelCol][0]
        return _Const(float(med), self.predictionCol)


class _Const:
    def __init__(self, value, col):
        self.value, self.col = value, col

    def transform(self, df):
        return df.withColumn(self.col, F.lit(self.value))


class KnnRegressor:
    """M3: exact k-NN regression on the assembled (scaled) features."""

    def __init__(self, k=presets.KNN_K, labelCol="label", predictionCol="prediction", id_col="id",
                 block_rows=2048):
        self.k, self.labelCol, self.predictionCol, self.id_col, self.block_rows = (
            k, labelCol, predictionCol, id_col, block_rows)

    def fit(self, df):
        self.ref = df
        return self

    def transform(self, df):
        from pyspark.ml.functions import vector_to_array

        from leasekit.operators.knn import knn_regress

        q = df.withColumn("_v", vector_to_array("features"))
        r = self.ref.withColumn("_v", vector_to_array("features"))
        pred = knn_regress(q, r, self.k, self.id_col, self.id_col, "_v", self.labelCol, block_rows=self.block_rows)
        return df.join(pred.select(F.col("qid").alias(self.id_col), F.col("prediction").alias(self.predictionCol)),
                       self.id_col, "left")


def ridge(alpha: float, n: int, label_std: float) -> LinearRegression:
    """M4: sklearn-style ridge. MLlib scales the L2 term by the label's population std and the
    loss by 1/n, so regParam = alpha * std(y) / n reproduces ||y - Xw||² + alpha||w||²."""
    return LinearRegression(elasticNetParam=0.0, regParam=alpha * label_std / max(n, 1),
                            standardization=False, solver="normal")


def lasso(alpha: float) -> LinearRegression:
    """M5: (1/2n)||y - Xw||² + alpha||w||₁."""
    return LinearRegression(elasticNetParam=1.0, regParam=alpha, standardization=False, maxIter=5000)


TREES = 300
#: One boosting operator; a preset for each library's defaults (leaf-wise: a limit on leaves, else on depth).
GBT_PRESETS = {
    "hist_gb": dict(depth=None, leaves=31, least_rows=20),
    "xgboost": dict(depth=8, rows_share=0.8, columns_share=0.8, l2=1.0),
    "lightgbm": dict(depth=None, leaves=63, least_rows=20),
    "catboost": dict(depth=8, l2=3.0),
}
#: Forests to purity, two rows in a leaf at least.
FOREST_PRESETS = {
    "random_forest": dict(kind="forest", depth=None, least_rows=2),
    "extra_trees": dict(kind="extra", depth=None, least_rows=2),
}
# Parameters of the final model when no search has been run.
FINAL_PARAMS = dict(trees=1200, rate=0.03, depth=10, least_rows=13, rows_share=0.65, columns_share=0.74, least_gain=0.001,
                    l1=0.0006, l2=0.19)
ZOO = ["ridge", "lasso", "knn_10", "decision_tree", "random_forest", "extra_trees", "hist_gb", "xgboost",
       "lightgbm", "catboost", "voting_lgbm_xgb_rf", "stacking_lgbm_rf_ridge"]
FINALISTS = ["xgboost", "lightgbm", "random_forest", "extra_trees", "voting_lgbm_xgb_rf"]
#: Fits that run at the same time (each is a chain of small jobs, so one alone leaves executors idle).
PARALLEL_FITS = 4


def at_once(jobs: Sequence[Callable]) -> list:
    """Results of independent fits, a few of which run at the same time."""
    with ThreadPoolExecutor(min(PARALLEL_FITS, max(1, len(jobs)))) as pool:
        return list(pool.map(lambda job: job(), jobs))


def tree_parameters(name: str, seed: int = presets.SEED, **more) -> Trees | None:
    """Parameters of a tree ensemble of the zoo, None for other models."""
    if name in GBT_PRESETS:
        return Trees("boost", TREES, 0.05, seed=seed, **GBT_PRESETS[name], **more)
    if name in FOREST_PRESETS:
        return Trees(trees=TREES, seed=seed, **FOREST_PRESETS[name], **more)
    return Trees("boost", seed=seed, **FINAL_PARAMS, **more) if name == "final" else None


def make_model(name: str, seed: int = presets.SEED, n_train: int = 0, label_std: float = 1.0):
    """Model zoo by name."""
    if name == "dummy_median":
        return MedianDummy()
    if name == "linear_regression":
        return LinearRegression(solver="normal", regParam=0.0)
    if name == "ridge":
        return ridge(1.0, n_train, label_std)
    if name == "lasso":
        return lasso(0.1)
    if name == "knn_10":
        return KnnRegressor(presets.KNN_K)
    if name == "decision_tree":
        return DecisionTreeRegressor(maxDepth=16, minInstancesPerNode=5, maxBins=64, seed=seed)
    if (ensemble := tree_parameters(name, seed)) is not None:
        return ensemble
    raise KeyError(name)


# ------------------------------------------------------------------ M10 M11 M12
def voting(preds: DataFrame, members: Sequence[str], out: str = "prediction") -> DataFrame:
    """The mean of the members' prediction columns."""
    return preds.withColumn(out, sum(F.col(m) for m in members) / len(members))


MEMBERS = {"voting_lgbm_xgb_rf": ["lightgbm", "xgboost", "random_forest"],
           "stacking_lgbm_rf_ridge": ["lightgbm", "random_forest", "ridge"]}
STACK_FOLDS = 3


def fit_models(names: Sequence[str], train: DataFrame, seed: int = presets.SEED, folds: Sequence[int | None] = (None,),
               id_col: str = "id") -> dict[tuple[str, int | None], object]:
    """(name, fold left out or None) -> fitted model, for all names and folds. All tree ensembles are one job; the others
    run beside each other."""
    keys = [(name, k) for name in dict.fromkeys(names) for k in folds]
    trees = [(key, spec) for key in keys if (spec := tree_parameters(key[0], seed, skip_fold=key[1])) is not None]
    fold = bucket(F.col(id_col), f"{seed}|stack", STACK_FOLDS)
    fitted = dict(zip([key for key, _ in trees], fit_all([s for _, s in trees], train, id_column=id_col, fold=fold))) if trees else {}
    rest = [key for key in keys if key not in fitted]
    parts = {k: train if k is None else train.filter(fold != k) for k in folds}
    return fitted | dict(zip(rest, at_once([partial(_fit, name, parts[k], seed) for name, k in rest])))


def needed(names: Sequence[str]) -> tuple[list[str], list[str]]:
    """Plain models to fit on all training rows, and those to fit on each stacking fold."""
    plain = [m for name in names for m in MEMBERS.get(name, [name])]
    return list(dict.fromkeys(plain)), [m for name in names if name.startswith("stacking") for m in MEMBERS[name]]


def fit_predict_all(names: Sequence[str], train: DataFrame, test: DataFrame, log_target: bool = False,
                    seed: int = presets.SEED) -> dict[str, DataFrame]:
    """Name -> ``test`` with ``prediction``; ensembles share the fits of their members.

    ``log_target`` (M12) fits on log1p(label) and back-transforms with expm1.
    """
    tr = train.withColumn("label", F.log1p("label")) if log_target else train
    plain, stacked = needed(names)
    fitted = fit_models(plain, tr, seed)
    fitted |= fit_models(stacked, tr, seed, range(STACK_FOLDS)) if stacked else {}
    out = {}
    for name in names:
        if name.startswith("voting"):
            columns = [f"_p{i}" for i in range(len(MEMBERS[name]))]
            preds = test
            for column, member in zip(columns, MEMBERS[name]):
                preds = _predict(fitted[member, None], preds, column)
            pred = voting(preds, columns).drop(*columns)
        elif name.startswith("stacking"):
            pred = stacking(tr, test, MEMBERS[name], fitted, seed)
        else:
            pred = fitted[name, None].transform(test)
        out[name] = pred.withColumn("prediction", F.expm1("prediction")) if log_target else pred
    return out


def fit_predict(name: str, train: DataFrame, test: DataFrame, log_target: bool = False,
                seed: int = presets.SEED) -> tuple[DataFrame, float]:
    """Fit on ``train`` and predict ``test``; returns (test with ``prediction``, fit seconds)."""
    t0 = time.time()
    out = fit_predict_all([name], train, test, log_target, seed)[name]
    return out, time.time() - t0


def _fit(name, train, seed):
    n, sd = 0, 1.0
    if name == "ridge":
        r = train.agg(F.count("label"), F.stddev_pop("label")).first()
        n, sd = int(r[0]), float(r[1] or 1.0)
    return make_model(name, seed, n, sd).fit(train)


def _predict(model, df, col):
    out = model.transform(df)
    return out.withColumnRenamed("prediction", col)


def stacking(train: DataFrame, test: DataFrame, bases: Sequence[str], fitted: dict, seed: int = presets.SEED,
             id_col: str = "id") -> DataFrame:
    """Out-of-fold base predictions -> ridge meta-model; bases refit on all training rows (``fit_models``)."""
    fold = bucket(F.col(id_col), f"{seed}|stack", STACK_FOLDS)
    columns = [f"_b{i}" for i in range(len(bases))]

    def predictions(k: int | None, rows: DataFrame) -> DataFrame:
        for column, base in zip(columns, bases):
            rows = _predict(fitted[base, k], rows, column)
        return rows

    oof = None
    for k in range(STACK_FOLDS):
        p = predictions(k, train.filter(fold == k).select(id_col, "label", "features")).select(id_col, "label", *columns)
        oof = p if oof is None else oof.unionByName(p)
    assemble = VectorAssembler(inputCols=columns, outputCol="_meta")
    from leasekit.session import materialize

    meta_in = materialize(assemble.transform(oof).select("label", "_meta"))
    r = meta_in.agg(F.count("label"), F.stddev_pop("label")).first()
    meta = ridge(1.0, int(r[0]), float(r[1] or 1.0)).setFeaturesCol("_meta").fit(meta_in)
    return meta.transform(assemble.transform(predictions(None, test))).drop("_meta", *columns)


# ------------------------------------------------------------------ M13–M18 M21
def run_experiment(name: str, model: str, m: Matrix, log_target: bool = False,
                   eval_part: str = "val", train_parts: Sequence[str] = ("train",)) -> DataFrame:
    """Fit on the training part(s), score ``eval_part``; long rows (run, model, metric, value)."""
    return run_suite(name, [model], m, log_target=log_target, eval_part=eval_part, train_parts=train_parts)


def run_suite(name: str, models: Sequence[str], m: Matrix, log_target: bool = False, eval_part: str = "val",
              train_parts: Sequence[str] = ("train",)) -> DataFrame:
    """All models of a stage, their tree ensembles fitted in one job; ``fit_seconds`` is that of the whole stage."""
    d = m.data
    t0 = time.time()
    preds = fit_predict_all(models, d.filter(F.col("split").isin(list(train_parts))), d.filter(F.col("split") == eval_part), log_target)
    secs = time.time() - t0
    rows = at_once([lambda p=p: compute_metrics(p, "label", "prediction").first() for p in preds.values()])
    vals = []
    for model, row in zip(preds, rows):
        vals += [(name, model, k, float(row[k]) if row[k] is not None else None) for k in METRICS]
        vals.append((name, model, "fit_seconds", float(secs)))
    return d.sparkSession.createDataFrame(vals, "run string, model string, metric string, value double")


# ------------------------------------------------------------------ I1 I2 I4
def builtin_importance(model, names: Sequence[str], spark, top: int = 25) -> DataFrame:
    """Tree importances normalised to 1, with feature names, top n."""
    imp = model.featureImportances
    imp = imp.toArray() if hasattr(imp, "toArray") else imp
    total = float(imp.sum()) or 1.0
    rows = [(n, float(v) / total) for n, v in zip(names, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


def permutation_importance(model, m: Matrix, part: str = "val", repeats: int = 5, seed: int = presets.SEED,
                           features: Sequence[str] | None = None) -> DataFrame:
    """MAE increase when one feature is shuffled, mean/std over ``repeats``.

    A repeat numbers all rows in the order of a hash, and each row takes the value of the next (the last of the
    first): a permutation of the whole part, found by a range sort and one join on the number. All (feature, repeat)
    variants are one DataFrame scored in one pass, without a further shuffle. For a linear model see
    :func:`_permuted_linear`.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import LinearRegressionModel

    from leasekit.operators.ranking import numbered

    names = list(features or m.names)
    d = m.data.filter(F.col("split") == part).select("id", "label", vector_to_array("features").alias("_x"))
    base_mae = compute_metrics(model.transform(m.data.filter(F.col("split") == part)), "label",
                               "prediction").select("mae")
    if isinstance(model, LinearRegressionModel):
        per = _permuted_linear(model, m.data.filter(F.col("split") == part), names, repeats, seed)
        return _mae_increase(per, base_mae)
    variants = None
    for r in range(repeats):
        rows, n = numbered(d.withColumn("_h", F.xxhash64(F.col("id"), F.lit(seed), F.lit(r))), ["_h", "id"], "_n")
        following = rows.select(F.pmod(F.col("_n") - 1, F.lit(max(n, 1))).alias("_n"), F.col("_x").alias("_src"))
        shifted = rows.join(following, "_n")
        # One row per (row, feature): replace element j by the following row's element j.
        v = shifted.select("id", "label", F.lit(r).alias("repeat"), "_x", "_src",
                           F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("_j"))
        v = v.select("id", "label", "repeat",
                     F.element_at(F.array(*[F.lit(x) for x in names]), F.col("_j") + 1).alias("feature"),
                     F.transform("_x", lambda x, i: F.when(i == F.col("_j"),
                                                           F.element_at(F.col("_src"), F.col("_j") + 1))
                                 .otherwise(x)).alias("_px"))
        variants = v if variants is None else variants.unionByName(v)
    scored = model.transform(variants.withColumn("features", array_to_vector("_px")))
    per = scored.groupBy("feature", "repeat").agg(F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("mae"))
    return _mae_increase(per, base_mae)


def _mae_increase(per: DataFrame, base_mae: DataFrame) -> DataFrame:
    return (per.groupBy("feature").agg(F.avg("mae").alias("mae_perm"), F.stddev_pop("mae").alias("std"))
               .select("feature", (F.col("mae_perm") - base_mae.scalar()).alias("mae_increase"), "std"))


#: Rows of a range of :func:`_permuted_linear`.
PERMUTED_ROWS = 1 << 18


def _permuted_linear(model, rows: DataFrame, names: Sequence[str], repeats: int, seed: int) -> DataFrame:
    """``feature, repeat, mae`` of a linear model: with one value replaced a prediction changes by the coefficient times the
    change, so a row costs a few numbers a feature, not a whole vector a feature.

    All repeats are one range sort by (repeat, hash, id); a task adds up the errors of neighbouring rows and gives the
    first and last row of each repeat in its range, whose neighbours lie in other ranges (some numbers a range in all).
    """
    import numpy as np
    import pyarrow as pa
    from pyspark.ml.functions import vector_to_array

    coefficients, intercept, k = model.coefficients.toArray(), float(model.intercept), len(names)

    def errors(y, x, following):
        """Sum over rows of the absolute error with each feature in turn taken from ``following``; rows without a label count not."""
        held = ~np.isnan(y)
        y, x, following = y[held], x[held], following[held]
        plain = x @ coefficients + intercept
        pred = plain[:, None] + (following[:, :k] - x[:, :k]) * coefficients[:k]
        for i in np.flatnonzero(~np.isfinite(plain)):  # what is replaced may be what is not finite
            changed = np.repeat(x[i:i + 1], k, 0)
            changed[np.arange(k), np.arange(k)] = following[i, :k]
            pred[i] = changed @ coefficients + intercept
        return np.abs(y[:, None] - pred).sum(0), int(held.sum())

    def part(batches):
        from pyspark import TaskContext

        place = TaskContext.get().partitionId()
        last, first, sums = None, {}, {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            r = batch.column("repeat").to_numpy()
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            if last is not None:
                r, y, x = np.append(last[0], r), np.append(last[1], y), np.vstack([last[2], x])
            for a in np.flatnonzero(np.append(True, r[1:] != r[:-1])):
                repeat, b = int(r[a]), int(np.searchsorted(r, r[a], "right"))
                first.setdefault(repeat, (y[a], x[a].copy()))
                total, count, _ = sums.get(repeat, (np.zeros(k), 0, None))
                if b - a > 1:
                    more, rows_ = errors(y[a:b - 1], x[a:b - 1], x[a + 1:b])
                    total, count = total + more, count + rows_
                sums[repeat] = total, count, (y[b - 1], x[b - 1].copy())
            last = r[-1:].copy(), y[-1:].copy(), x[-1:].copy()
        for repeat, (total, count, (end_y, end_x)) in sums.items():
            start_y, start_x = first[repeat]
            yield pa.record_batch([pa.array([repeat], pa.int32()), pa.array([place], pa.int32()), pa.array([count], pa.int64()),
                                   *(pa.array([v.astype("<f8").tobytes()], pa.binary()) for v in (total, np.append(start_y, start_x), np.append(end_y, end_x)))],
                                  names=["repeat", "place", "n", "sums", "first", "last"])

    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() * repeats // PERMUTED_ROWS))
    copies = rows.select("id", "label", "features", F.explode(F.array(*[F.lit(r) for r in range(repeats)])).alias("repeat"))
    copies = copies.withColumn("_h", F.xxhash64(F.col("id"), F.lit(seed), F.col("repeat")))
    ranged = copies.repartitionByRange(parts, "repeat", "_h", "id").sortWithinPartitions("repeat", "_h", "id")
    found = ranged.select("repeat", F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x")) \
        .mapInArrow(part, "repeat int, place int, n long, sums binary, first binary, last binary").collect()  # a row a range and repeat
    out = []
    for r in range(repeats):
        ranges = sorted((f for f in found if f.repeat == r), key=lambda f: f.place)
        if not ranges:
            continue
        ends, starts = (np.stack([np.frombuffer(f[c]) for f in ranges]) for c in ("last", "first"))
        total, count = errors(ends[:, 0], ends[:, 1:], np.roll(starts, -1, 0)[:, 1:])
        total, count = total + sum(np.frombuffer(f.sums) for f in ranges), count + sum(f.n for f in ranges)
        out += [(name, r, float(v) / count if count else None) for name, v in zip(names, total)]
    return spark.createDataFrame(out, "feature string, repeat int, mae double")


def residuals(pred: DataFrame, y: str = "label", p: str = "prediction", keep: Sequence[str] = ()) -> DataFrame:
    """I4: (y, p, residual) rows, after the columns ``keep``."""
    return pred.select(*keep, F.col(y).alias("y"), F.col(p).alias("p"), (F.col(y) - F.col(p)).alias("residual"))
